"""Seed samples for the fit (W1, W2, W3) and their checks.

Samples are deterministic: every vector gets the key
``md5('<seed>:<question_id>')`` and a sample keeps the smallest keys. That is a
uniform draw without replacement that does not depend on partitioning or task
order, and both forms are bounded top-k plans:

* W1 (per language) is ``row_number() <= per_lang`` over ``PARTITION BY x, salt``, then
  over ``PARTITION BY x``; Spark plans a partial ``WindowGroupLimit`` before each shuffle,
  so each task sends at most ``per_lang`` rows per language and salt.
* W2 (language-blind) is ``ORDER BY key LIMIT k``, a ``TakeOrderedAndProject``
  that keeps k rows per task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postclust.params import Params


class SampleError(ValueError):
    """The seed sample does not have the required shape."""


def sample_key(question_id, seed: int):
    return F.md5(F.concat(F.lit(f"{seed}:"), question_id.cast("string")))


# Tasks over which the candidates of one language are spread before they meet.
SALTS = 32


def sample_per_language(vectors: DataFrame, params: Params) -> DataFrame:
    """``per_lang`` vectors of every x value, with their rank ``rn`` (1-based).

    Two limits: the smallest keys of each (x, salt), then of these those of each x. So one
    task meets at most ``SALTS * per_lang`` rows of a language, however many tasks
    scan it.
    """
    per_lang = params.per_lang
    keyed = vectors.select("question_id", "x", "y", sample_key(F.col("question_id"), params.seed).alias("h"))
    keyed = keyed.withColumn("salt", F.pmod(F.hash("question_id"), F.lit(SALTS)))
    first = Window.partitionBy("x", "salt").orderBy("h", "question_id")
    last = Window.partitionBy("x").orderBy("h", "question_id")
    return (
        keyed.withColumn("rn", F.row_number().over(first))
        .filter(F.col("rn") <= per_lang)
        .withColumn("rn", F.row_number().over(last))
        .filter(F.col("rn") <= per_lang)
        .select("question_id", "x", "y", "rn")
    )


def sample_global(vectors: DataFrame, params: Params) -> DataFrame:
    """``kernels`` vectors regardless of language, ranked by key (``rn``)."""
    keyed = vectors.select("question_id", "x", "y", sample_key(F.col("question_id"), params.seed).alias("h"))
    top = keyed.orderBy("h", "question_id").limit(params.kernels)
    return top.select("question_id", "x", "y", F.row_number().over(Window.orderBy("h", "question_id")).alias("rn"))


UNIFORM_BITS = 52  # exact in a double


def sample_uniform(question_id, seed: int):
    """A number in [0, 1) that only the seed and the id decide."""
    top = F.conv(F.substring(sample_key(question_id, seed), 1, UNIFORM_BITS // 4), 16, 10)
    return top.cast("double") / F.lit(float(1 << UNIFORM_BITS))


# Draws of one row with replacement; a Poisson count of rate 1 is above this
# with a probability under 1e-17, which a 52-bit uniform cannot show.
MAX_DRAWS = 18


def poisson_steps(rate: float) -> list[float]:
    """Probabilities that a Poisson count is at most 0, 1, 2, ..."""
    term = total = math.exp(-rate)
    steps = [total]
    for k in range(1, MAX_DRAWS):
        term *= rate / k
        total += term
        steps.append(total)
    return steps


def sample_fraction(vectors: DataFrame, fraction: float = 0.1, with_replacement: bool = True, seed: int = 0) -> DataFrame:
    """Bernoulli sample of the rows, or Poisson (each row as often as a
    Poisson count of rate ``fraction`` says, at most 1) with replacement.

    The draw is the row's uniform number, compared with the fraction or sent
    through the inverse Poisson distribution, so it does not depend on how the
    rows are partitioned.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    u = sample_uniform(F.col("question_id"), seed)
    if not with_replacement:
        return vectors.filter(u < fraction)
    steps = F.array(*[F.lit(p) for p in poisson_steps(fraction)])
    draws = F.size(F.filter(steps, lambda p: p <= u))
    copies = F.when(draws > 0, F.sequence(F.lit(1), draws)).otherwise(F.array().cast("array<int>"))
    return vectors.select("*", F.explode(copies).alias("_draw")).drop("_draw")


def sample_sizes(sample: DataFrame, params: Params) -> DataFrame:
    """C3 + C4 as data: vectors per x of a seed sample, and whether that is
    what the parameters ask for (``per_lang`` each; ``kernels`` in all if the
    sample is global)."""
    counts = sample.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    if params.global_sample:
        total = sample.agg(F.count(F.lit(1)).alias("n")).scalar()
        return counts.select("x", "n", (total == params.kernels).alias("complete"))
    return counts.select("x", "n", (F.col("n") == params.per_lang).alias("complete"))


def seed_sample(vectors: DataFrame, params: Params) -> DataFrame:
    """The seed sample the fit starts from (W2 for a small spread, else W1),
    with cluster ids: ``(cid, question_id, x, y)``.

    The result has at most ``kernels`` (W2) or ``per_lang`` rows per x value
    (W1), so the cid numbering window runs on a bounded input.
    """
    if params.global_sample:
        s = sample_global(vectors, params)
        order = Window.orderBy("rn")
    else:
        s = sample_per_language(vectors, params)
        order = Window.orderBy("x", "rn")
    return s.select((F.row_number().over(order) - 1).cast("int").alias("cid"), "question_id", "x", "y")


def initial_centers(vectors: DataFrame, params: Params) -> list[tuple[int, int, int]]:
    """Collect the seed sample (bounded by the sample size) as ``(cid, x, y)``
    and check its shape (C3, C4)."""
    rows = seed_sample(vectors, params).collect()
    check_sample(rows, params)
    return [(r["cid"], r["x"], r["y"]) for r in sorted(rows, key=lambda r: r["cid"])]


def check_sample(rows, params: Params) -> None:
    if not params.global_sample:
        per_x: dict[int, int] = {}
        for r in rows:
            per_x[r["x"]] = per_x.get(r["x"], 0) + 1
        short = sorted(x for x, c in per_x.items() if c < params.per_lang)
        if short:  # C3
            raise SampleError(f"language groups with fewer than {params.per_lang} vectors: x in {short}")
    if len(rows) != params.kernels:  # C4
        raise SampleError(
            f"seed sample has {len(rows)} vectors, {params.kernels} expected "
            "(a language without questions, or questions of unknown language?)"
        )
