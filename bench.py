"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line with seconds per query.

Every query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected). Before timing, every headline query runs once
on the smallest tables ($BENCH_WARM_DIR, default sf0.001), so JVM start-up,
class loading and JIT warm-up are not charged to whichever query comes first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fairstream.plans import catalog  # noqa: E402
from fairstream.plans.queries import land_streams  # noqa: E402
from fairstream.session import get_session  # noqa: E402

HEADLINE = [
    # clustering
    "assign_nearest", "assign_nearest_nd", "fair_phi", "cluster_group_stats",
    "lloyd_2rounds", "fair_kmeans_1round", "fair_kmeans_1round_nd", "kmeans_summary",
    "kmeans_report", "compare_centers",
    # sketches and heavy hitters
    "cms_cells", "cs_estimate", "heavy_hitters", "sketch_error", "hitter_report",
    "distinct_summary",
    # streams
    "running_counts", "running_distinct", "stream_sketch_cells", "stream_cs_cells",
    "stream_prefix", "stream_report",
]

# the throughput of the running histogram, the distinct set and both sketches).
STREAM_INPUT = {
    "running_counts": "events", "running_distinct": "events",
    "stream_sketch_cells": "lineitem", "stream_cs_cells": "lineitem",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="fairstream-bench")
    qs = catalog.queries()
    names = only or HEADLINE

    for name in names:                                   # warm-up, not timed
        qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    if any(name.startswith(("running_", "stream_")) for name in names):
        land_streams(spark, sf_dir)                      # the replayed copies, not timed

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count()
            for t in sorted(set(STREAM_INPUT.values()))}
    derived = {
        "sec_per_fair_round": times.get("fair_kmeans_1round"),
        "sec_per_fair_round_64d": times.get("fair_kmeans_1round_nd"),
        "sec_per_kmeans_report": times.get("kmeans_report"),
        "rows_per_sec": {q: round(rows[t] / times[q]) for q, t in STREAM_INPUT.items()
                         if times.get(q)},
    }
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "derived": derived,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
