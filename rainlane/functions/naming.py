"""Ids, locations, dates and sizes as text and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def day_after(start: str | Column, days: Column) -> Column:
    first = F.to_date(F.lit(start)) if isinstance(start, str) else start
    return F.date_add(first, days.cast("int"))


def artifact_id(kind: Column, stamp: Column) -> Column:
    return F.concat_ws("_", kind, stamp)


def artifact_location(base: str, key: Column) -> Column:
    return F.format_string("%s/%s", F.lit(base.rstrip("/")), key)


def kilobytes(length: Column) -> Column:
    return length / F.lit(1024.0)
