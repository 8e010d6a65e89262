"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]: one warm-up, then the median of $BENCH_REPEAT runs. A run
executes the whole plan into Spark's `noop` sink (every row is produced, no
result is pulled to the driver). Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "word_count",
    "incremental_extract",
    "keep_last",
    "upsert_replace",
    "upsert_protect",
    "top_n",
    "html_links",
    "title_keywords",
    "doc_word_count",
    "keep_last_nested",
]


#: Queries over a file of one row group that take a number of tasks from their caller.
DEALT = {"doc_word_count"}


def _driver_memory() -> str:
    """Half of physical memory, at most 16g (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(16, int(total / 2**30 * 0.5)))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from threadmill.session import get_spark
    from threadmill.plans.catalog import QUERIES

    spark = get_spark("threadmill-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", _driver_memory())})
    timings: dict[str, float] = {}
    for name in names:
        fn = QUERIES[name]

        def run():
            t0 = time.perf_counter()
            fn(spark, sf_dir, **({"tasks": int(cpus)} if name in DEALT else {})).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up: JIT, file listing, Python workers
        timings[name] = round(statistics.median(run() for _ in range(repeat)), 4)
        print(f"{name}: {timings[name]:.3f}s", file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
