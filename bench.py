"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is timed from building its DataFrame to the end of a full run
into Spark's ``noop`` sink (every row computed, nothing collected).  The
same queries first run once, untimed, on the smallest test tables so the
timings are of a warm JVM (compiled code paths), as on a running cluster.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dimforge.config import local_session, use_scratch  # noqa: E402
from dimforge.queries import QUERIES  # noqa: E402

HEADLINE = [
    "conformed_plan",
    "load_all_published",
    "conformed_field",
    "conformed_site",
    "conformed_site_analysis",
    "conformed_variety",
    "plan_staging",
    "join_star",
    "semi_active",
    "group_sum_area",
    "union_widen_distinct",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="dimforge-bench")
    use_scratch(spark)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
