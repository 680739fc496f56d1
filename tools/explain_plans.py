"""Write the physical plans of the main queries to PLANS.md.

    python tools/explain_plans.py [sf_dir] > PLANS.md

Automatic broadcast joins are switched off so the plans show the shape they
take when the tables are large (sort-merge joins on the keys).
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postclust.operators.kmeans import cluster_means  # noqa: E402
from postclust.plans.analysis import seed_and_points  # noqa: E402
from postclust.plans.catalog import QUERIES, WIDE, _postings, _vectors  # noqa: E402
from postclust.session import build_session  # noqa: E402
from postclust.sources.stored import store_postings  # noqa: E402

SHOWN = [
    ("q_bad_records", "parse + quarantine (S2, S3)"),
    ("q_text_postings", "lines of a text file, scanned and parsed (S1, S2)"),
    ("q_scored_questions", "best answer score per question (A2, A3)"),
    ("q_join_pairs", "question/answer pairs (J1)"),
    ("q_left_join_questions", "left join as pairs + unanswered (J2)"),
    ("q_grouped_counts", "pairs per question from per-key counts (A1, A12)"),
    ("q_weighted_points", "weighted points"),
    ("q_sample_per_language", "per-language seed sample (W1)"),
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        checkpoint_dir=tempfile.mkdtemp(prefix="plans-ckpt-"),
        extra_conf={"spark.ui.showConsoleProgress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"},
    )
    print("# Physical plans\n")
    print(f"Generated by `tools/explain_plans.py` on `{sf_dir}` with automatic broadcast joins off "
          "(the shape for large tables). Adaptive execution may still coalesce partitions or split skewed "
          "ones at run time.\n")
    for name, title in SHOWN:
        print(f"## {name}: {title}\n\n```\n{_plan(QUERIES[name](spark, sf_dir))}```\n")
    init, points = seed_and_points(_vectors(spark, sf_dir, WIDE), WIDE)
    step = cluster_means(points, init)
    store = store_postings(_postings(spark, sf_dir))
    print(f"## pairs of postings stored by question (J1): no exchange\n\n```\n{_plan(store.pairs())}```\n")
    print(f"## scores of postings stored by question (A3): only the salts of hot questions meet\n\n```\n{_plan(store.scored())}```\n")
    store.drop()
    print(f"## one fit step (K1) over the cached single-partition points\n\n```\n{_plan(step)}```")


if __name__ == "__main__":
    main(sys.argv)
