"""From the table documents to packed training sequences, in five stages.

Each stage works on all that the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.llm import exact_dedup, language, mixing, packing, shingle_join
from rainlane.llm.common import table
from rainlane.llm.queries import TARGETS
from rainlane.staging import stage

#: A document that is farther than this from all profiles is in none of their languages. The
#: first is the score that a text of few n-grams needs, the second that of a text with as many
#: as a profile has; between them the limit rises with the number of n-grams. A short text has
#: few ranks to agree with, so its score says less.
LEAST_SCORE, LEAST_SCORE_LONG = 0.2, 0.26

#: Rows that a worker gets at a time; texts may be long, and a worker holds what it got.
ROWS_AT_ONCE = 1000

#: Words that the mixing stage draws, with repeats where that needs them. None: as many as
#: the targets allow without repeats.
MIX_WORDS: int | None = None


def short_batches(spark: SparkSession) -> None:
    """A setting of the session that this pipeline runs in; results don't depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents themselves name. Those without
    a letter and those far from every profile go; those without a label get the language
    found. Where no language is named, all stay."""
    short_batches(spark)
    profiles = language.learn_profiles(docs)
    if not profiles.languages:
        return docs
    found = language.identify(docs, profiles)
    least = LEAST_SCORE + (LEAST_SCORE_LONG - LEAST_SCORE) * F.col("n_grams") / profiles.size
    near = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= least)
    row = F.col("row")
    label = F.coalesce(row.getField("lang"), "lang_pred")
    return found.where(near).select(
        *[(label if name == "lang" else row.getField(name)).alias(name) for name in docs.columns]
    )


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts, blanks aside."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group linked by a similarity of 0.8 on five-word shingles."""
    short_batches(spark)
    return shingle_join.drop_near_copies(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target shares of words."""
    short_batches(spark)
    mixed = mixing.mix(docs, mixing.n_words(), mixing.text_margins(), TARGETS, budget=MIX_WORDS)
    return mixing.drawn(mixed)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens, with their ids."""
    short_batches(spark)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, tokenizer).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express the stages; they are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
