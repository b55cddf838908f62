"""Written tables in the shared folder: they cut lineage, survive the loss of an
executor, and are read back by their columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folders made since each enclosing ``own_folders`` began.
_made: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rainlane-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/rainlane/{name}-{uuid.uuid4().hex}"
    for folders in _made:
        folders.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def is_there(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


@contextmanager
def own_folders(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that were made within the block at its end. For plans that
    write their results elsewhere; frames over staged tables don't outlive the block."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            remove(spark, path)
