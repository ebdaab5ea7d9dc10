"""Time the registered queries; prints one JSON line.

    BENCH_SF_DIR   folder of the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores            (default 8)
    BENCH_RUNS     runs per query         (default 2; the fastest counts)

Arguments name the queries to run; without any, all of them run. Every result is
computed in full (noop sink) and nothing of it reaches the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curbair.queries import QUERIES  # noqa: E402
from curbair.session import build_session  # noqa: E402


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", int(cpus), {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="curbair-bench-"))

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {
        name: round(min(run(name) for _ in range(runs)), 3) for name in names or QUERIES
    }
    scale = re.search(r"sf([0-9.]+)$", folder)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "runs": runs, "sf": float(scale.group(1)) if scale else folder,
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
