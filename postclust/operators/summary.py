"""Cluster summary.

Two aggregation levels, no per-cluster lists: first per (cluster, language)
the question count and the exact median score (a selection by ranges over the
weighted points, whose state is bounded), then per cluster the size and the
dominant language. Count ties between languages go to the smaller x.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postclust.functions.lang import lang_label
from postclust.operators.kmeans import Centers, weight_column, assign
from postclust.params import Params


def cluster_lang_stats(points: DataFrame, centers: Centers) -> DataFrame:
    """A7 (+ the per-language median of A10): ``(cid, x, n, median_score)``."""
    return lang_stats_of_assigned(assign(points, centers))


def lang_stats_of_assigned(assigned: DataFrame) -> DataFrame:
    """A7 + per-language median over vectors that already carry ``cid``
    (optionally weighted by ``n``)."""
    weighted = assigned.select("cid", "x", "y", weight_column(assigned).alias("n"))
    stats = weighted_medians(weighted, ["cid", "x"], "y", "n")
    return stats.select("cid", "x", F.col("total").alias("n"), F.col("median").alias("median_score"))


# Bits of the lower part of a value; a 32-bit value has as many upper ones.
RANGE_BITS = 16


def weighted_medians(rows: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """A10: ``(keys, total, median)``, the exact median of an INT ``value`` that stands for ``weight``
    rows each; of an even number the mean of the two in the middle, truncated toward zero.

    Two rounds of selection: weights are summed by the value's upper half, and prefix sums
    tell in which ranges the two middle rows lie; then the values within these ranges only
    are summed and told apart likewise. Both sums are partial aggregates, and a window meets
    at most ``2 ** RANGE_BITS`` rows of a group, however many values it has.
    """
    upper = F.shiftright(F.col(value), RANGE_BITS)

    def placed(sums: DataFrame, group: list[str], at: str) -> DataFrame:
        """Rows with the number of rows before them in their group, and up to them."""
        w = Window.partitionBy(*group).orderBy(at)
        upto = F.sum("w").over(w)
        return sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("w"))

    ranges = rows.groupBy(*keys, upper.alias("upper")).agg(F.sum(weight).alias("w"))
    counted = placed(ranges, keys, "upper").withColumn("total", F.sum("w").over(Window.partitionBy(*keys)))
    # the middle rows, numbered from 0: one row if the total is odd, else two
    middle = F.array(F.expr("(total - 1) div 2"), F.expr("total div 2"))
    targets = counted.select("*", F.posexplode(middle).alias("half", "nth")).where("before <= nth AND nth < upto").select(
        *keys, "total", "half", "upper", (F.col("nth") - F.col("before")).alias("nth"))
    near = rows.withColumn("upper", upper).join(targets.select(*keys, "upper").distinct(), [*keys, "upper"])
    values = near.groupBy(*keys, "upper", value).agg(F.sum(weight).alias("w"))
    found = placed(values, [*keys, "upper"], value).join(targets, [*keys, "upper"]).where("before <= nth AND nth < upto")
    mean = F.expr(f"CAST(sum(CAST({value} AS BIGINT)) div 2 AS INT)")
    return found.groupBy(*keys).agg(F.first("total").alias("total"), mean.alias("median"))


def summarize_clusters(lang_stats: DataFrame, params: Params) -> DataFrame:
    """One row per non-empty cluster."""
    per_cluster = lang_stats.groupBy("cid").agg(
        F.sum("n").alias("size"),
        F.max_by(
            F.struct("x", "n", "median_score"), F.struct(F.col("n"), -F.col("x"))
        ).alias("dom"),
    )
    return per_cluster.select(
        "cid",
        lang_label(F.col("dom.x"), params.langs, params.spread).alias("lang"),
        (F.col("dom.n") * F.lit(100.0) / F.col("size")).alias("pct"),
        F.col("size").cast("bigint").alias("size"),
        F.col("dom.median_score").alias("median_score"),
    )


def cluster_results(points: DataFrame, centers: Centers, params: Params) -> DataFrame:
    """K4 + O1: cluster summary ordered by median score (then cid)."""
    return summarize_clusters(cluster_lang_stats(points, centers), params).orderBy("median_score", "cid")
