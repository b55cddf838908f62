"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores,
BENCH_REPEATS how often each query runs (the fastest run counts), BENCH_SECONDS from when
on each query runs only once. Each query's time goes to stderr as it ends.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from rainlane.checks.registered import QUERIES
from rainlane.session import local_session

HEADLINE = (
    "unpack_parallel_arrays",
    "etl_trusted",
    "raw_level_stats",
    "stage_row_counts",
    "global_stats",
    "level_stats",
    "correlations",
    "corr_matrix",
    "equal_width_bins",
    "binned_mean_temp",
    "binned_mean_precip",
    "level_totals",
    "chart_bars_one_pass",
    "skew_sliced_join",
    "csv_roundtrip",
    "json_records",
    "eval_report",
    "stream_ingest",
    "incremental_trusted",
    "hot_keys_join",
    "set_aside_arrivals",
    "compacted_arrivals",
    "daily_run",
    "boosting_rounds",
    "stored_model_scores",
    "score_rf",
    "score_gbt",
)


def timed(spark, name: str, folder: str) -> float:
    """Seconds of one run; every row and column of the result is computed."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "rainlane-bench")
    limit, begun = float(os.environ.get("BENCH_SECONDS", "600")), time.perf_counter()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        runs = [timed(spark, name, folder)]
        while len(runs) < repeats and time.perf_counter() - begun < limit:
            runs.append(timed(spark, name, folder))
        seconds[name] = round(min(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
