"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is run to completion with a no-op write (every row computed,
nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordgraph.plans.registry import QUERIES  # noqa: E402
from wordgraph.session import local_session, release_cuts  # noqa: E402

HEADLINE = [
    "pagerank_keep",
    "pagerank_drop",
    "overlap_edges",
    "overlap_edges_hybrid",
    "q1_larger_source",
    "q2_popular_vertex",
    "q3_neighbor_average_orders",
    "q4_popular_word",
    "q5_largest_component",
    "q6_word_presence",
    "components_edges",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    folder = os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="wordgraph-bench-")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus), app="wordgraph-bench", checkpoint=folder)
    # One untimed run of the first query, so that it is timed like the others.
    QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    release_cuts(spark)
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        release_cuts(spark)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
