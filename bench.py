"""Benchmark: run the headline queries on the driver tables and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is executed completely (a ``noop`` write forces all rows without
collecting them into Python); the k-means queries run their fit loop inside the
call. ``value`` is the sum of the per-query seconds.

Before timing, the same queries run once, untimed, over the smallest tables
(``BENCH_WARMUP_DIR``, default ``/root/testdata/sf0.001``; empty to skip) so
the timings reflect a warmed-up JVM (loaded classes, JIT-compiled planner) as
on a long-running cluster, not the start-up of a fresh one.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from postclust.plans.catalog import QUERIES  # noqa: E402
from postclust.session import build_session  # noqa: E402

HEADLINE = [
    "q_parse_postings",
    "q_bad_records",
    "q_join_pairs",
    "q_left_join_questions",
    "q_grouped_counts",
    "q_scored_questions",
    "q_weighted_points",
    "q_sample_per_language",
    "q_kmeans_fit_wide",
    "q_kmeans_fit_narrow",
    "q_cluster_summary",
    "q_report",
]


def _sf(sf_dir: str):
    m = re.search(r"sf([0-9.]+)", sf_dir)
    return float(m.group(1)) if m else sf_dir


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        checkpoint_dir=tempfile.mkdtemp(prefix="bench-ckpt-"),  # one machine; a cluster names its own
        extra_conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warmup_dir and os.path.isdir(warmup_dir):
        for name in HEADLINE:  # untimed
            QUERIES[name](spark, warmup_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()

    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf(sf_dir),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
