"""Text form of any value, for served records in which every value is a string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text(value: Column, dtype: T.DataType) -> Column:
    """Text of a value: ISO dates, milliseconds on timestamps, ``{k=v, ...}`` for
    structs and maps, ``[a, b]`` for arrays; missing inner values read ``null``."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSS")
    if isinstance(dtype, T.StructType):
        parts = [
            F.concat(F.lit(f.name + "="), _inner(value.getField(f.name), f.dataType))
            for f in dtype.fields
        ]
        return F.when(value.isNotNull(), _enclosed("{", F.array(*parts), "}"))
    if isinstance(dtype, T.MapType):
        pairs = F.transform(
            F.map_entries(value),
            lambda e: F.concat(
                _inner(e["key"], dtype.keyType), F.lit("="), _inner(e["value"], dtype.valueType)
            ),
        )
        return F.when(value.isNotNull(), _enclosed("{", pairs, "}"))
    if isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda e: _inner(e, dtype.elementType))
        return F.when(value.isNotNull(), _enclosed("[", items, "]"))
    return value.cast("string")


def _inner(value: Column, dtype: T.DataType) -> Column:
    return F.coalesce(as_text(value, dtype), F.lit("null"))


def _enclosed(left: str, items: Column, right: str) -> Column:
    return F.concat(F.lit(left), F.array_join(items, ", "), F.lit(right))


def text_columns(df: DataFrame) -> list[Column]:
    """Every column as text, with the empty string where a value is missing."""
    return [
        F.coalesce(as_text(F.col(f"`{f.name}`"), f.dataType), F.lit("")).alias(f.name)
        for f in df.schema.fields
    ]
