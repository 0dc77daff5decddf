"""Benchmark: run every registered report at $BENCH_SF_DIR and print one JSON line.

Each report is executed in full with Spark's ``noop`` sink (the whole plan
runs, including final sorts, but no rows are shipped to the driver). One
warm-up report runs first and is not counted.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_KEYS (optional comma-separated subset, for local iteration only),
BENCH_SHUFFLE_PARTITIONS (default 2 x cpus).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from marketlens.plans import REPORTS
    from marketlens.plans.registry import run_report
    from marketlens.session import build_session
    from marketlens.sources.mart import Mart

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    spark = build_session(f"local[{cpus}]", app_name="marketlens-bench", shuffle_partitions=shuffle,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # Production layout: the ingest step publishes the nine tables once and
    # every report reads them. Publishing is timed and counted in the total.
    from marketlens.session import scratch_path
    t0 = time.perf_counter()
    mart = Mart.from_testdata(spark, sf_dir).write(scratch_path(spark, f"bench-mart-{os.getpid()}"))
    build = round(time.perf_counter() - t0, 3)
    keys = list(REPORTS)
    subset = os.environ.get("BENCH_KEYS")
    if subset:
        keys = [k for k in keys if any(re.fullmatch(p, k) for p in subset.split(","))]

    run_report("q4_1_total_orders", mart).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {"mart_publish": build}
    for key in keys:
        t0 = time.perf_counter()
        run_report(key, mart).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_report_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "n_queries": len(times),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
