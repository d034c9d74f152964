"""Time the registered queries: one JSON line with the seconds of each.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local threads. Arguments pick queries by name. Every query
runs once to warm the session's code and file caches and is then timed three times, from building the frame to the last row;
the median counts. A stream starts from nothing each time and runs once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from rtmart.registry import queries
from rtmart.session import build_session


def run_once(spark, fn, sf_dir: str) -> float:
    start = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    picked = sys.argv[1:]
    seconds: dict[str, float] = {}
    for name, fn in queries().items():
        if picked and name not in picked:
            continue
        once = name.endswith("_stream")
        if not once:
            run_once(spark, fn, sf_dir)
        seconds[name] = round(median(run_once(spark, fn, sf_dir) for _ in range(1 if once else 3)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
