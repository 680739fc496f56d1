"""Exact integer k-means.

The centers are the only driver state: at most ``kernels`` integer pairs. One
step is one Spark job over the weighted points (``kmeans_step``):

    every point finds its nearest center by binary search among the break points
    of its x (at most k, made on the driver from the centers)
    -> per-center weighted sums (partial aggregate per task, <= k rows each)
    -> integer centroid ``sum(x * n) div sum(n)`` (truncation toward zero)

and the k resulting rows are overlaid on the previous centers, so a center
that attracts no point keeps its position. The loop stops when the total
squared shift is below ``eta`` or after ``max_iterations`` steps; the latest
centers are returned either way.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postclust.functions.geometry import point_shift, total_shift, with_nearest
from postclust.params import Params

Centers = list[tuple[int, int, int]]  # (cid, x, y), cid = position

# Weighted coordinate sums: coordinate (< 2**31) times weight (up to the number
# of questions) can pass the BIGINT range, so they are summed as exact decimals.
SUM_TYPE = "DECIMAL(38,0)"


def different_xs(points: DataFrame) -> list[int]:
    """The x values of the points, at most one more than there are languages."""
    return sorted(r["x"] for r in points.select("x").distinct().collect())


def assign(points: DataFrame, centers: Centers, xs: list[int] | None = None) -> DataFrame:
    """Add ``cid``, the nearest center of every row's (x, y); equal distances go to the
    center listed first. ``xs``: the different x, looked up if not given."""
    if not centers:
        raise ValueError("at least one center is needed")
    found = with_nearest(points, [(x, y) for _, x, y in centers], different_xs(points) if xs is None else xs, "_pos")
    return found.select(*points.columns, F.expr(f"array({', '.join(str(int(c)) for c, _, _ in centers)})[_pos]").alias("cid"))


def weight_column(points: DataFrame) -> F.Column:
    return F.col("n") if "n" in points.columns else F.lit(1).cast("bigint")


def cluster_means(points: DataFrame, centers: Centers, xs: list[int] | None = None) -> DataFrame:
    """A4 + A5: ``(pos, mx, my, size)`` of every non-empty cluster, by the position
    of its center. A points table of one partition needs no exchange; a larger one
    sends at most k partial rows per task."""
    weighted = points if "n" in points.columns else points.select("x", "y", weight_column(points).alias("n"))
    placed = with_nearest(weighted, [(x, y) for _, x, y in centers], different_xs(points) if xs is None else xs)
    mean = lambda c: F.expr(f"CAST(sum(CAST({c} AS {SUM_TYPE}) * n) div sum(n) AS INT) AS m{c}")
    return placed.groupBy("pos").agg(mean("x"), mean("y"), F.expr("sum(n) AS size"))


def kmeans_step(points: DataFrame, centers: Centers, xs: list[int] | None = None) -> Centers:
    """K1: one update; empty clusters keep their previous center."""
    moved = {r["pos"]: (r["mx"], r["my"]) for r in cluster_means(points, centers, xs).collect()}
    return [(cid, *moved.get(i, (x, y))) for i, (cid, x, y) in enumerate(centers)]


def converged(shift: float, params: Params) -> bool:
    """V4: strict test on the total squared shift."""
    return shift < params.eta


@dataclass
class FitResult:
    centers: Centers
    iterations: int
    converged: bool
    shift: float
    trace: list[tuple] = field(default_factory=list)


TRACE_SCHEMA = T.StructType([
    T.StructField("it", T.IntegerType(), False),
    T.StructField("cid", T.IntegerType(), False),
    T.StructField("old_x", T.IntegerType(), False),
    T.StructField("old_y", T.IntegerType(), False),
    T.StructField("new_x", T.IntegerType(), False),
    T.StructField("new_y", T.IntegerType(), False),
    T.StructField("shift", T.DoubleType(), False),
    T.StructField("total_shift", T.DoubleType(), False),
    T.StructField("converged", T.BooleanType(), False),
])


def fit(points: DataFrame, init: Centers, params: Params) -> FitResult:
    """K2 (+ K3 trace): iterate K1 until the total shift is below ``eta`` or
    ``max_iterations`` steps ran. ``points`` should be small and persisted
    (see ``plans.analysis.prepare_points``); each step reads it once."""
    if not init:
        raise ValueError("at least one initial center is needed")
    centers = [(int(c), int(x), int(y)) for c, x, y in init]
    xs = different_xs(points)
    trace: list[tuple] = []
    it = 0
    while True:
        it += 1
        new = kmeans_step(points, centers, xs)
        shift = total_shift([(x, y) for _, x, y in centers], [(x, y) for _, x, y in new])
        done = converged(shift, params)
        for (cid, ox, oy), (_, nx, ny) in zip(centers, new):
            trace.append((it, cid, ox, oy, nx, ny, point_shift((ox, oy), (nx, ny)), shift, done))
        centers = new
        if done or it >= params.max_iterations:
            return FitResult(centers, it, done, shift, trace)


def trace_frame(spark: SparkSession, result: FitResult) -> DataFrame:
    """K3: the iteration trace, at most ``kernels * max_iterations`` rows."""
    return spark.createDataFrame(result.trace, TRACE_SCHEMA)


def centers_frame(spark: SparkSession, centers: Centers) -> DataFrame:
    schema = "cid INT, mx INT, my INT"
    return spark.createDataFrame([(int(c), int(x), int(y)) for c, x, y in centers], schema)
