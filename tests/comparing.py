"""Rows in a form that can be compared between engines."""

import math
from datetime import date, datetime

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=_sort_key)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.isoformat() if value.time().isoformat() != "00:00:00" else value.date().isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _sort_key(row):
    return [(value is None, str(type(value)), value if value is not None else 0) for value in row]
