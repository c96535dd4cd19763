"""Time every named query and print one line of JSON.

BENCH_SF_DIR is the folder of the tables (default /root/testdata/sf0.1), BENCH_CPUS the number
of local cores. A query's time covers planning, every job it starts and producing all of its
rows, not deleting what it wrote meanwhile; BENCH_RUNS (default 2) repeats each query and
keeps its best time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kalends.catalog import QUERIES  # noqa: E402
from kalends.session import local_session  # noqa: E402
from kalends.storage import temporary  # noqa: E402


def seconds(build, spark, sf_dir: str) -> float:
    with temporary(spark):
        started = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds(QUERIES["yoy_by_year"], spark, sf_dir)  # start the JVM's compilers and the file caches
    times = {name: round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3) for name in chosen}
    print(json.dumps({
        "metric": "total time of all queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
        "driver_memory": spark.conf.get("spark.driver.memory", "default"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
