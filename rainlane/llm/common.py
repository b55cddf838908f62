"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A sample table, a file or a folder of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


Batches = Iterator[pa.RecordBatch]


def freeing(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``function`` as it is, but at the end of its task the worker gives the memory back
    that its caches took; workers live on, and the next stage may need it."""

    @wraps(function)
    def freed(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return freed


def with_row(given: DataFrame, more: str) -> T.StructType:
    """The column row of ``given``, as it is whatever the names in it, and the columns of the
    DDL text ``more``."""
    return T.StructType([given.schema["row"], *T.StructType.fromDDL(more).fields])


def has_bit(bits: Column, place: Column) -> Column:
    """Whether a bitmap as ``bitmap_construct_agg`` makes it has the bit."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings that hold within the block only."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def place_in_files(df: DataFrame) -> tuple[Column, Column]:
    """File and number of the row within it, for a table read from Parquet files; also where
    a column of the table has the name of the hidden one."""
    hidden = df.metadataColumn("_metadata")
    return hidden.getField("file_path"), hidden.getField("row_index")
