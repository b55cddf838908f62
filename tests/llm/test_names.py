"""Every operator on tables with further columns of odd and clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rainlane.llm import embedding_dedup, exact_dedup, line_dedup, packing, quality, sharding, shingle_join, warc

ODD = ["my col-1", "a.b", "row", "lang_pred", "score", "keep_id", "file", "text_", "tokens", "0", "É", "own", "id"]
KEPT = "doc_id long, text string, lang string, source string"


@pytest.fixture
def docs(spark, tmp_path):
    rows = [(i, f"the cat and the other things were there with them number {i % 7}", "en", "s") for i in range(20)]
    rows += [(None, None, None, None), (31, "", "de", None), (32, "12 34", "de", "s")]
    frame = spark.createDataFrame(rows, KEPT).select("*", *[F.lit("x").alias(name) for name in ODD])
    frame.write.parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs")


def test_stages(spark, docs, tmp_path):
    for at, (_, function) in enumerate(corpus_pipeline.STAGES):
        now = function(spark, docs, "")
        if at < 4:
            assert now.columns == docs.columns
        now.write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
    assert docs.count() > 0


def test_operators_on_documents(spark, docs):
    assert exact_dedup.exact_dedup(docs).count() == 23
    assert sharding.shard_by_bytes(docs, shards=2).count() == 23
    assert line_dedup.drop_repeated_lines(docs).select("row.*").columns == docs.columns
    numbers = quality.featurise(docs)
    roles = numbers.select((F.col("row.doc_id") % 2).cast("int").alias("role"), "row", "numbers")
    assert quality.score(roles, quality.learn(roles)).count() == 23
    assert shingle_join.similar_groups(docs.where("doc_id is not null"), width=4, percent=85).count() == 22
    assert packing.pack(docs, packing_path(), with_ids=False).count() >= 23


def packing_path():
    from rainlane.llm.queries import TOKENIZER

    return TOKENIZER


def test_operators_on_pages_and_vectors(spark, tmp_path):
    odd = [F.lit("x").alias(name) for name in ODD if name != "id"]
    pages = spark.createDataFrame([(i, "http://a/", f"<p>{i % 3}") for i in range(6)], "page_id long, url string, html string")
    pages.select("*", *odd).write.parquet(f"{tmp_path}/pages")
    assert warc.archive_round_trip(spark.read.parquet(f"{tmp_path}/pages")).count() == 6
    vectors = spark.createDataFrame([(i, [1.0, float(i % 2)]) for i in range(6)], "vec_id long, embedding array<float>")
    found = embedding_dedup.near_duplicates(vectors.select("*", *odd), threshold=0.9)
    assert {r.n_links for r in found.collect()} == {2}
