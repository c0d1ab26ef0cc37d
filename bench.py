"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the tables and the cores.  Each query
runs once to warm up and once for the clock, computing every row and column of
its result.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workloads.check import session  # noqa: E402
from workloads.queries import QUERIES  # noqa: E402

HEADLINE = [
    "build_pair", "build_pair_cross_source", "build_all", "build_all_from_atoms", "nested_pairs",
    "score_with_error", "apportion", "rate", "compare_official", "residential_flags", "reconcile",
    "legacy_pair_overrides", "tag_units", "pip_join", "zonal_sum", "two_way_match", "overlap_report", "area_by_key",
]


def run(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in HEADLINE:
        run(spark, name, sf)
        times[name] = round(run(spark, name, sf), 3)
    print(json.dumps({"metric": "total warm time of headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
