"""Seconds per headline query, warm: the median of several full runs after one unmeasured run.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (measured runs per query).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.plans.catalog import QUERIES  # noqa: E402
from basketry.session import build_session  # noqa: E402

# A stream or a job runs in full when its query is built, so one measured run is enough; tables are written then, too.
ONCE = ("_stream", "_table", "_state")


def once(name: str) -> bool:
    return name.endswith(ONCE) or name.startswith("job_")


def run(spark, name: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in QUERIES:
        if once(name):
            seconds[name] = round(run(spark, name, folder), 3)
            continue
        run(spark, name, folder)
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
