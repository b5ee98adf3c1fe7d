"""Times every registered query and prints one JSON line.

BENCH_SF_DIR   table directory, default /root/testdata/sf0.1
BENCH_CPUS     local cores, default 8
BENCH_RUNS     timed runs per query after a warm-up, default 3

The tables that queries share are timed as `build_*`, each run writing a new
copy; queries then read the session's copy. A figure is the median of its runs
after a warm-up. A query run executes the whole plan into a sink that drops the
rows, so nothing is pruned and nothing passes the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from shelfwise import registry, staging
from shelfwise.plans.transform import process
from shelfwise.plans.warehouse import write_star
from shelfwise.session import local_session, scratch_dir
from shelfwise.sources.sample_feed import sample_feed


def _seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def drain(query) -> None:
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()

    def median(action) -> float:
        action()
        return round(statistics.median(_seconds(action) for _ in range(runs)), 3)

    staging.star(spark, sf_dir)
    lake, processed = staging.lake(spark, sf_dir), staging.processed(spark, sf_dir)
    times = {
        "build_lake": median(lambda: sample_feed(spark, sf_dir).write.parquet(scratch_dir(spark))),
        "build_processed": median(lambda: process(lake).write.parquet(scratch_dir(spark))),
        "build_star": median(lambda: write_star(processed, scratch_dir(spark))),
    }
    for name, query in registry.queries().items():
        times[name] = median(lambda: drain(query))
    print(
        json.dumps(
            {
                "metric": "sum of builds and median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
