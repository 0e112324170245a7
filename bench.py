"""Times every registered query and prints one JSON line.

Results go to the ``noop`` sink, so all rows and columns are computed. Each
query runs once to warm up the JVM on the smallest tables, then once for time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from checks.queries import QUERIES
from marketloom.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_DIR = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main(names: list[str]) -> None:
    spark = local_session(CPUS, "bench")
    chosen = names or list(QUERIES)
    warm = Path(WARM_DIR).is_dir()
    seconds = {}
    for name in chosen:
        if warm:
            run(QUERIES[name], spark, WARM_DIR)
        seconds[name] = round(run(QUERIES[name], spark, SF_DIR), 3)
        print(f"{name:26s} {seconds[name]:8.2f}s", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = Path(SF_DIR).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
