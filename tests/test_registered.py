"""Each registered query against its SQL, on the sample tables."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.comparing import TABLES, comparable

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def database(tables):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    yield connection
    connection.close()


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert all(re.fullmatch(r"[a-z][a-z0-9_]*", name) for name in QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, tables, database, name):
    df = QUERIES[name](spark, tables)
    got = comparable(df.columns, df.collect())
    cursor = database.execute(SQL[name])
    want = comparable([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want
    assert want[1]


@pytest.mark.parametrize("name", ["score_rf", "score_gbt"])
def test_every_row_is_scored(spark, tables, database, name):
    rows = QUERIES[name](spark, tables).collect()
    assert len(rows) == len(database.execute(SQL["score_rf_levels"]).fetchall())
    assert all(r.predicted_incidents is not None for r in rows)


def test_entry(spark):
    if not Path(entry_point.SMOKE_FOLDER).exists():
        pytest.skip("no sample tables")
    assert entry_point.entry(spark).count() == 3
