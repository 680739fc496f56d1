"""Command line: cluster the postings of text files and print the report (K5 + S5).

    spark-submit --py-files postclust.zip postclust/__main__.py /data/postings/ [--spread 50000 ...]
    python -m postclust postings.csv --master local[8]

Bad lines fail the job (``--mode failfast``, the default) or are written aside
(``--mode quarantine --bad-out <folder>``; all parsed lines are kept beside it, in
``<folder>-parsed-...``, so that the text is read once).
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession

from postclust.operators.kmeans import trace_frame
from postclust.params import DEFAULT_ETA, DEFAULT_KERNELS, DEFAULT_LANGS, DEFAULT_MAX_ITERATIONS, DEFAULT_SPREAD, Params
from postclust.plans.analysis import run_analysis
from postclust.session import RECOMMENDED_CONF
from postclust.sources.report import print_report
from postclust.sources.text import GOOD, parse_postings, quarantine, read_lines


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="postclust", description=__doc__.splitlines()[0])
    ap.add_argument("paths", nargs="+", help="posting text files or folders")
    ap.add_argument("--langs", default=",".join(DEFAULT_LANGS), help="comma-separated languages, in index order")
    ap.add_argument("--spread", type=int, default=DEFAULT_SPREAD)
    ap.add_argument("--kernels", type=int, default=DEFAULT_KERNELS)
    ap.add_argument("--eta", type=float, default=DEFAULT_ETA)
    ap.add_argument("--max-iterations", type=int, default=DEFAULT_MAX_ITERATIONS)
    ap.add_argument("--drop-unknown", action="store_true", help="leave questions of unknown language out")
    ap.add_argument("--mode", choices=("failfast", "quarantine", "drop"), default="failfast")
    ap.add_argument("--bad-out", help="parquet folder for bad lines (quarantine mode)")
    ap.add_argument("--expect-rows", type=int, help="fail unless this many vectors are built")
    ap.add_argument("--trace", action="store_true", help="print every fit iteration (old/new centers, shifts)")
    ap.add_argument("--master", help="Spark master when not launched by spark-submit")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("postclust")
    if args.master:
        builder = builder.master(args.master)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()

    params = Params(
        langs=tuple(args.langs.split(",")), spread=args.spread, kernels=args.kernels, eta=args.eta,
        max_iterations=args.max_iterations, drop_unknown=args.drop_unknown,
    )
    lines = read_lines(spark, args.paths)
    if args.mode == "quarantine" and args.bad_out:
        # the text is read once; what follows reads the parsed lines
        parsed = quarantine(lines, f"{args.bad_out.rstrip('/')}-parsed-{uuid.uuid4().hex}")
        parsed.bad.write.mode("overwrite").parquet(args.bad_out)
        for reason, n in parsed.counts.items():
            if reason != GOOD:
                print(f"bad lines: {n} ({reason})")
    else:
        parsed = parse_postings(lines, mode=args.mode)
    analysis = run_analysis(parsed.postings, params, expect_rows=args.expect_rows)
    r = analysis.result
    if args.trace:
        trace_frame(spark, r).orderBy("it", "cid").show(len(r.trace), truncate=False)
    print(f"fit: {r.iterations} iterations, total shift {r.shift:g}, "
          f"{'converged' if r.converged else 'stopped at the iteration limit'}")
    print_report(analysis.summary)
    analysis.release()


if __name__ == "__main__":
    main()
