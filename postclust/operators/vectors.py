"""Question vectors (P6) and their weighted form.

Every later step (seeded fit, assignment, summary) only needs how many
questions sit on each distinct point ``(x, y)``: centroids are weighted sums,
sizes are sums of weights and the median is a frequency percentile. The
weighted table has at most (languages + 1) x (distinct scores) rows, whatever
the number of postings, and is built with a map-side partial count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postclust.functions.lang import lang_factor, lang_index, lang_label
from postclust.operators.postings import ANSWER, QUESTION
from postclust.params import UNKNOWN_LANG_X, Params


def vectorize(scored: DataFrame, params: Params) -> DataFrame:
    """``(question_id, x, y)`` with x the language factor and y the best score."""
    vec = scored.select(
        F.col("question_id"),
        lang_factor(F.col("tags"), params.langs, params.spread).alias("x"),
        F.col("high_score").cast("int").alias("y"),
    )
    if params.drop_unknown:
        vec = vec.filter(F.col("x") != UNKNOWN_LANG_X)
    return vec


def score_vectors(postings: DataFrame, params: Params) -> DataFrame:
    """A3 and P6 in one pass: the vectors of all answered questions.

    Every posting is keyed once (a question by its id, an answer by its parent)
    and both kinds fold in one aggregate on integers: the best answer score, and
    the question's tag as its place among the sorted languages. A language has an
    odd place, other tags the even one between their neighbours, a missing tag the
    last, so copies of an id fold to the smallest tag as in A3. Same rows as
    ``vectorize(score_questions(postings), params)``, which reads the input twice.
    """
    kind, tag = F.col("posting_type"), F.col("tags")
    langs = sorted(set(params.langs), key=lambda s: s.encode())
    below = reduce(Column.__add__, [(tag > F.lit(lang)).cast("int") for lang in langs])
    place = F.when(tag.isNull(), 2 * len(langs) + 2).otherwise(2 * below + tag.isin(langs).cast("int"))
    key = F.when(kind == QUESTION, F.col("id")).when(kind == ANSWER, F.col("parent_id"))
    folded = (
        postings.select(key.alias("question_id"), F.when(kind == QUESTION, place).alias("place"),
                        F.when(kind == ANSWER, F.col("score")).alias("score"))
        .filter(F.col("question_id").isNotNull())
        .groupBy("question_id").agg(F.min("place").alias("place"), F.max("score").alias("best"))
        .filter(F.col("place").isNotNull() & F.col("best").isNotNull())
    )
    factors = F.array(*[F.lit(params.langs.index(lang) * params.spread) for lang in langs])
    x = F.when(F.col("place") % 2 == 1, F.get(factors, F.floor(F.col("place") / 2).cast("int"))).otherwise(UNKNOWN_LANG_X)
    vec = folded.select("question_id", x.cast("int").alias("x"), F.greatest(F.lit(0), "best").cast("int").alias("y"))
    return vec.filter(F.col("x") != UNKNOWN_LANG_X) if params.drop_unknown else vec


def weigh_points(vectors: DataFrame) -> DataFrame:
    """``(x, y, n)``: number of vectors on each distinct point."""
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))


def with_labels(vectors: DataFrame, params: Params) -> DataFrame:
    """P7 + P8: language index and name recovered from x."""
    return vectors.select(
        "*",
        lang_index(F.col("x"), params.spread).alias("lang_index"),
        lang_label(F.col("x"), params.langs, params.spread).alias("lang"),
    )
