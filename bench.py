"""Time every registered query; prints one JSON line.

Each result is computed in full and thrown away (``noop``), as a write would compute
it. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose tables and threads, ``BENCH_RUNS`` how
often each query runs (the best run counts), ``BENCH_QUERIES`` a comma-separated subset.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import registry  # noqa: E402
from incident_mart.session import build_session  # noqa: E402


def seconds(spark, run, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus),
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.driver.extraJavaOptions": "-XX:+UseParallelGC",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first job pays for starting the engine, whichever query it belongs to.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name, run in registry.queries().items():
        if not wanted or name in wanted:
            times[name] = round(min(seconds(spark, run, sf_dir) for _ in range(runs)), 3)
    total = round(sum(times.values()), 3)
    line = {"metric": "total_query_seconds", "value": total, "unit": "sec"}
    print(json.dumps({**line, "queries": times, "sf": sf_dir.rstrip("/").split("sf")[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
