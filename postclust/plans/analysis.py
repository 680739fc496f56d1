"""The whole analysis (K5): postings -> scores -> vectors -> seeded fit -> summary.

Jobs, in order:

1. vectors (one scan, one keyed partial aggregate), persisted because two
   consumers read them;
2. weighted points ``(x, y, n)`` (partial count), sized into few partitions and
   cut from their lineage (reliable checkpoint in the session's shared
   checkpoint folder when there is one); the job that counts them also checks the
   number of vectors (C6);
3. seed sample (bounded top-k, <= kernels rows reach the driver and are checked
   there, C3 and C4), after which the vectors are released;
4. one job per fit iteration over the weighted points (<= kernels rows back);
5. the summary over the weighted points (<= kernels rows).

Nothing but centers and summary rows (both bounded by ``kernels``) passes
through the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postclust.operators.kmeans import Centers, FitResult, fit
from postclust.operators.sampling import initial_centers
from postclust.operators.summary import cluster_results
from postclust.operators.vectors import score_vectors, weigh_points
from postclust.params import Params
from postclust.session import ensure_checkpoint_dir

# Weighted points per partition of the persisted fit input; a step's cost is
# dominated by task overhead well below this size.
POINTS_PER_PARTITION = 200_000


class RowCountError(AssertionError):
    """The number of vectors differs from the expected count."""


def prepare_points(vectors: DataFrame, expect_rows: int | None = None) -> DataFrame:
    """Weighted points, materialized once for the fit loop and the summary.

    The rows are counted to size the table at ``ceil(rows / POINTS_PER_PARTITION)``
    partitions, written to the shared checkpoint folder when there is one, and
    cached with that partition count, so that a one-partition table is known as
    such to the planner and a fit step runs without an exchange. The same job sums
    the weights, which is the number of vectors (C6).
    """
    weighted = weigh_points(vectors).persist(StorageLevel.MEMORY_AND_DISK)
    rows, total = weighted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if expect_rows is not None and total != expect_rows:
        weighted.unpersist()
        raise RowCountError(f"{total} vectors, {expect_rows} expected")
    parts = max(1, math.ceil(rows / POINTS_PER_PARTITION))
    sized = weighted.coalesce(parts)  # coalesce never raises the partition count
    if ensure_checkpoint_dir(sized.sparkSession):
        sized = sized.checkpoint(eager=True).coalesce(parts)
    sized = sized.persist(StorageLevel.MEMORY_AND_DISK)
    sized.count()
    weighted.unpersist()
    return sized


@dataclass
class Analysis:
    points: DataFrame          # weighted points (x, y, n), materialized
    init: Centers              # seed centers
    result: FitResult          # fitted centers + trace
    summary: DataFrame         # (cid, lang, pct, size, median_score), ordered

    def release(self) -> None:
        self.points.unpersist()


def seed_and_points(vectors: DataFrame, params: Params, expect_rows: int | None = None) -> tuple[Centers, DataFrame]:
    """Seed centers and materialized weighted points from one pass over the
    (persisted) vectors; the vectors are released afterwards."""
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        points = prepare_points(vectors, expect_rows)
        try:
            init = initial_centers(vectors, params)
        except Exception:
            points.unpersist()
            raise
    finally:
        vectors.unpersist()
    return init, points


def fit_vectors(vectors: DataFrame, params: Params, expect_rows: int | None = None) -> tuple[DataFrame, Centers, FitResult]:
    """Seeded fit (K2) over vectors: ``(points, init, result)``."""
    init, points = seed_and_points(vectors, params, expect_rows)
    return points, init, fit(points, init, params)


def run_analysis(postings: DataFrame, params: Params, expect_rows: int | None = None) -> Analysis:
    """K5: the whole analysis from postings to the ordered cluster summary."""
    vectors = score_vectors(postings, params)
    points, init, result = fit_vectors(vectors, params, expect_rows)
    summary = cluster_results(points, result.centers, params)
    return Analysis(points, init, result, summary)
