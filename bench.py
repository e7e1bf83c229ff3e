"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line with per-query seconds. Each
query is executed in full into Spark's ``noop`` sink (every row computed,
nothing collected to the driver). One untimed warm-up run absorbs JVM start-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terrane.plans import registry  # noqa: E402
from terrane.session import build_session  # noqa: E402

HEADLINE = ["A1", "A2", "A3", "A4", "A5", "A9", "A13", "A14", "A16", "A26", "A29", "Q3k",
            "S6", "S7", "S21", "G3", "J4", "F1", "F12", "M8", "M17", "R2"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="terrane-bench")
    keys = [k for k in HEADLINE if k in registry.REGISTRY]
    registry.REGISTRY["A2"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for k in keys:
        t0 = time.perf_counter()
        registry.REGISTRY[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
