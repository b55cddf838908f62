import math
import random
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rainlane.functions import casting
from rainlane.functions.binning import bin_edges
from rainlane.functions.correlation import pearson
from rainlane.functions.encoding import ordinal_code
from rainlane.functions.text import text_columns
from rainlane.operators.charts import bin_of, edges_of
from rainlane.operators.summary import correlation_matrix

INT_TEXTS = [
    "12", "12.0", " 7 ", "-3.9", ".5", ".", "abc", "12.x", "+4", "", "1e3", "99999999999",
    None, "3.", "-.5", "-", "+-3", "1 2", "2147483647", "2147483648.5", "-2147483648", "0x1F",
]


def test_lenient_int_equals_the_cast_without_ansi(spark):
    texts = spark.createDataFrame([(t,) for t in INT_TEXTS], "t string")
    got = texts.select("t", casting.lenient_int("t").alias("n")).collect()
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = texts.select("t", F.col("t").cast("int").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert got == want


def test_lenient_date(spark):
    texts = ["2022-01-31", "2022-1-3", "2022-02-30", "nope", "", None, "2022-05-06 10:00:00"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(casting.lenient_date("t")).collect()]
    assert got == [
        date(2022, 1, 31), date(2022, 1, 3), None, None, None, None, date(2022, 5, 6)
    ]


def test_rounding_is_half_up(spark):
    rows = spark.createDataFrame([(2.5,), (-2.5,), (0.49,), (1.5,), (None,)], "x double")
    got = [r[0] for r in rows.select(casting.rounded_int("x")).collect()]
    assert got == [3, -3, 0, 2, None]


def test_ordinal_code_defaults(spark):
    labels = [("Bajo",), ("Medio",), ("Alto",), ("bajo",), ("Otro",), (None,)]
    rows = spark.createDataFrame(labels, "label string")
    coded = rows.select(ordinal_code(F.col("label"), {"Bajo": 1, "Medio": 2}, 3).alias("code"))
    assert [r[0] for r in coded.collect()] == [1, 2, 3, 3, 3, 3]
    assert coded.schema["code"].dataType.simpleString() == "int"


def binned(spark, values, bins):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    edges = edges_of(rows, ["x"], bins)
    got = rows.select("i", bin_of("x", edges).alias("b")).orderBy("i").collect()
    return [r.b for r in got], edges.get("x")


@pytest.mark.parametrize("bins", [1, 2, 7, 8])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bins_equal_pandas_cut(spark, bins, seed):
    rng = random.Random(seed)
    values = [round(rng.uniform(-40, 60), 1) for _ in range(3000)]
    got, edges = binned(spark, values, bins)
    cut, want_edges = pd.cut(pd.Series(values), bins=bins, retbins=True, labels=False)
    assert got == cut.tolist()
    assert edges == pytest.approx(want_edges.tolist(), abs=1e-9)


@pytest.mark.parametrize("value", [0.0, 5.0, -3.25, 1e6])
@pytest.mark.parametrize("bins", [3, 8])
def test_one_single_value_is_binned_as_by_pandas(spark, value, bins):
    got, _ = binned(spark, [value] * 4, bins)
    assert got == pd.cut(pd.Series([value] * 4), bins=bins, labels=False).tolist()


def test_values_on_an_edge_and_missing_values(spark):
    got, _ = binned(spark, [0.0, 1.0, 1.5, 8.0, None, math.nan], 8)
    assert got == [0, 0, 1, 7, None, None]


@pytest.mark.parametrize("bins", [1, 3, 8, 50])
def test_bins_of_neighbouring_numbers(spark, bins):
    """A range of a few steps of a double, where edges fall together."""
    values = [1e16 + 2.0 * i for i in range(12)]
    got, _ = binned(spark, values, bins)
    assert got == pd.cut(pd.Series(values), bins=bins, labels=False, duplicates="drop").tolist() or all(
        b == sum(v > e for e in bin_edges(values[0], values[-1], bins)[1:-1]) for v, b in zip(values, got)
    )


def test_infinite_values_are_refused(spark):
    with pytest.raises(ValueError, match="infinite"):
        binned(spark, [1.0, math.inf], 8)


def test_no_value_at_all(spark):
    assert binned(spark, [None, None], 8) == ([None, None], None)


def test_pearson_skips_unpaired_values(spark):
    rng = random.Random(5)
    rows = [
        tuple(None if rng.random() < 0.2 else rng.gauss(0, 1) for _ in range(3)) for _ in range(500)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    want = pd.DataFrame(rows, columns=list("abc"), dtype=float).corr()
    got = {(r.row_var, r.col_var): r.r for r in correlation_matrix(df, list("abc")).collect()}
    assert len(got) == 9
    for (a, b), r in got.items():
        assert r == pytest.approx(want.loc[a, b], abs=1e-12)
        assert r == got[b, a]
    assert all(got[v, v] == 1.0 for v in "abc")


def test_pearson_without_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert df.agg(pearson(F.col("a"), F.col("b"))).first()[0] is None
    assert df.limit(1).agg(pearson(F.col("a"), F.col("b"))).first()[0] is None
    assert df.where("a > 5").agg(pearson(F.col("a"), F.col("b"))).first()[0] is None
    diagonal = {r.row_var: r.r for r in correlation_matrix(df, ["a", "b"]).collect() if r.row_var == r.col_var}
    assert diagonal == {"a": None, "b": 1.0}


def test_text_of_every_type(spark):
    row = spark.sql(
        "SELECT 1 AS i, CAST(NULL AS STRING) AS s, 1.5D AS d, true AS b, DATE'2022-01-02' AS day, "
        "TIMESTAMP'2022-01-02 03:04:05' AS ts, named_struct('w', 1, 'h', CAST(NULL AS INT)) AS st, "
        "map('k', 'v', 'n', CAST(NULL AS STRING)) AS m, array(1, 2) AS a, "
        "CAST(NULL AS STRUCT<w: INT>) AS ns"
    )
    assert row.select(*text_columns(row)).first().asDict() == {
        "i": "1", "s": "", "d": "1.5", "b": "true", "day": "2022-01-02",
        "ts": "2022-01-02 03:04:05.000", "st": "{w=1, h=null}", "m": "{k=v, n=null}",
        "a": "[1, 2]", "ns": "",
    }
