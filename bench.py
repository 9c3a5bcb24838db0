"""Benchmark: run every catalogue query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed into Spark's ``noop`` sink (no collect to the driver),
$BENCH_RUNS times (default 3); the fastest run is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from casegauge.plans import catalogue  # noqa: E402
from casegauge.session import build_session  # noqa: E402


RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(sys.argv[1:])
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    times: dict[str, float] = {}
    for name, fn in catalogue.REGISTRY.items():
        if only and name not in only:
            continue
        best = None
        for _ in range(RUNS):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        print(f"{name}: {best:.3f}s", file=sys.stderr, flush=True)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
