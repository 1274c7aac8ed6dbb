"""Benchmark: time every headline query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely with the `noop` sink (all rows produced,
nothing collected to the driver). Prints one JSON line.

Every query is first run once on sf0.001 as a warm-up (not timed).

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 1; the median of repeats is reported),
     BENCH_QUERIES (comma list to restrict).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cinerank.plans.catalog import queries  # noqa: E402
from cinerank.session import build_session  # noqa: E402

# The grid search fits nine models; it is a tuning run, not a query.
SKIP = {"tune_als"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", app="cinerank-bench", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g"})
    qs = {k: v for k, v in queries().items() if k not in SKIP and (not only or k in only)}
    # Warm-up: every query once on the smallest data set, so JIT, generated
    # code for each plan shape and the Python workers are ready; the timed
    # runs then measure the data work.
    warm = "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else sf_dir
    for fn in qs.values():
        fn(spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, fn in qs.items():
        runs = []
        for _ in range(repeat):
            # same starting state for every timed run: no leftover caches,
            # no garbage from the previous query pending in the driver JVM
            spark.catalog.clearCache()
            spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
