"""Benchmark: run every registered query on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is built and executed to the end with the ``noop`` sink (all rows
computed, nothing collected to the driver). After a warm-up query, every
query runs ``$BENCH_REPEATS`` times (default 1) and its median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.queries import queries  # noqa: E402
from strata.session import build_session  # noqa: E402


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, int(cpus) * 2),
                          app_name="strata-bench")
    catalogue = queries()
    names = only or sorted(catalogue)
    run_once(spark, catalogue["venue_year_panel"], sf_dir)  # warm-up: JVM, Python workers
    timings: dict[str, float] = {}
    failures: dict[str, str] = {}
    for name in names:
        try:
            runs = [run_once(spark, catalogue[name], sf_dir) for _ in range(repeats)]
            timings[name] = round(statistics.median(runs), 3)
        except Exception as exc:  # keep measuring the others
            failures[name] = repr(exc)[:300]
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
           "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus),
           "repeats": repeats}
    if failures:
        out["failures"] = failures
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
