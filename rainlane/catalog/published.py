"""Which run's tables are served.

A run writes its refined tables to a folder of its own. A log says since when which dataset is
that of which run; one small file with all datasets of a run is the step by which they are
published together. The external tables follow the log, and ``follow_log`` puts them
right after a run that failed between the two.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.catalog.datasets import dataset_tables, register_datasets
from rainlane.schemas import TEXT, TIME, struct
from rainlane.settings import Layout
from rainlane.staging import remove
from rainlane.streaming.ledger import read_or_empty

LOG = struct(dataset=TEXT, run=TEXT, published_at=TIME)
MODELS = "models"  # fitted models are published as datasets are


def publications(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_or_empty(spark, layout.published, LOG)


def current_runs(spark: SparkSession, layout: Layout) -> dict[str, str]:
    """Dataset -> run that it was last published from. A row per dataset comes to the driver."""
    latest = publications(spark, layout).groupBy("dataset").agg(F.max_by("run", F.struct("published_at", "run")).alias("run"))
    return {r.dataset: r.run for r in latest.collect()}


def publish(
    spark: SparkSession, layout: Layout, run: str, names: Iterable[str], database: str | None = None, keep: int = 2
) -> None:
    """Serve ``names`` from ``run`` from now on; other datasets stay where they are. The last
    ``keep`` runs of each dataset stay, folders of older ones are deleted."""
    now = datetime.now(timezone.utc)
    rows = spark.createDataFrame([(name, run, now) for name in names], LOG)
    rows.coalesce(1).write.mode("append").parquet(layout.published)
    if database:
        follow_log(spark, layout, database)
    _clear(spark, layout, keep)


def follow_log(spark: SparkSession, layout: Layout, database: str) -> None:
    """Put each external table where the log says that its dataset is."""
    tables = dataset_tables(layout)
    for name, run in sorted(current_runs(spark, layout).items()):
        if name in tables:
            register_datasets(spark, layout.of_run(run), database, [name])


def _clear(spark: SparkSession, layout: Layout, keep: int) -> None:
    runs: dict[str, list[tuple]] = {}
    for r in publications(spark, layout).collect():
        runs.setdefault(r.dataset, []).append((r.published_at, r.run))
    wanted = {run for own in runs.values() for _, run in sorted(own)[-keep:]}
    for run in {run for own in runs.values() for _, run in own} - wanted:
        remove(spark, layout.run_folder(run))
