"""Question/answer joins (J1, J2) and grouped pair counts.

Skew: one question may own a large share of all answers. The joins are laid
out so that the hot side can always be split:

* J1 is an inner join with the answers on the streamed (left) side; adaptive
  execution may split a skewed answers partition and replicate the matching
  question rows, which an inner join allows on either side. Without adaptive
  skew handling, hot questions are salted explicitly instead.
* J2 (left outer) would pin the skewed answers to the non-splittable side, so it
  is written as J1 plus the unanswered questions. The latter come from an
  anti join against the *distinct* parent ids, which the partial aggregate
  collapses map-side, so no hot key crosses the shuffle.
* A1 never materializes the pairs: answers and questions are counted per key
  in one map-side partial aggregate, and the pair count is the product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postclust.operators.postings import ANSWER, QUESTION, answers, questions

PAIR_COLUMNS = ["question_id", "tags", "question_score", "answer_id", "answer_score"]


# A question holding more than this share of all answers is hot; at most
# 1 / HOT_KEY_SHARE questions can be, which bounds the broadcast hot-key list.
HOT_KEY_SHARE = 1e-4
SALT_BUCKETS = 64  # tasks a hot question's answers are spread over when salting


def _aqe_splits_skew(spark) -> bool:
    def on(key: str) -> bool:
        return str(spark.conf.get(key, "true")).lower() == "true"

    return on("spark.sql.adaptive.enabled") and on("spark.sql.adaptive.skewJoin.enabled")


def join_pairs(postings: DataFrame, salted: bool | None = None) -> DataFrame:
    """Every (question, answer) pair; unanswered questions and orphan answers vanish.

    With adaptive skew join on (the default), the plain join is planned and a
    hot question's partition is split at run time. Otherwise (or with
    ``salted=True``) hot questions are salted explicitly, see ``salted_pairs``.
    """
    a = answers(postings)
    q = questions(postings).select("question_id", "tags", "question_score")
    if salted is None:
        salted = not _aqe_splits_skew(postings.sparkSession)
    if salted:
        return salted_pairs(a, q)
    return a.join(q, "question_id", "inner").select(*PAIR_COLUMNS)


def salted_pairs(a: DataFrame, q: DataFrame, buckets: int = SALT_BUCKETS,
                 share: float = HOT_KEY_SHARE) -> DataFrame:
    """J1 with explicit salting of hot keys.

    Hot questions (more than ``share`` of all answers, found with a partial
    count per key) get their answers spread over ``buckets`` salt values by a
    hash of all the answer's columns (answer ids repeat), and their question row copied once per salt value;
    every other key keeps salt 0. The join on ``(question_id, salt)`` then
    sends a hot question's answers to ``buckets`` tasks. Same rows as the plain
    join.
    """
    counts = a.groupBy("question_id").count()
    threshold = counts.agg((F.sum("count") * F.lit(share)).alias("t")).scalar()
    hot = F.broadcast(  # at most 1 / share rows
        counts.filter(F.col("count") > threshold).select("question_id", F.lit(True).alias("hot"))
    )
    a_salted = a.join(hot, "question_id", "left").withColumn(
        "salt",
        F.when(F.col("hot"), F.pmod(F.xxhash64(*a.columns), F.lit(buckets))).otherwise(F.lit(0)).cast("int"),
    )
    q_salted = q.join(hot, "question_id", "left").withColumn(
        "salt",
        F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))),
    )
    return a_salted.join(q_salted, ["question_id", "salt"], "inner").select(*PAIR_COLUMNS)


def left_join_questions(postings: DataFrame, salted: bool | None = None) -> DataFrame:
    """Every question with each of its answers, or once with NULL answer columns."""
    pairs = join_pairs(postings, salted)
    answered = answers(postings).select("question_id").distinct()
    unanswered = (
        questions(postings)
        .select("question_id", "tags", "question_score")
        .join(answered, "question_id", "left_anti")
        .select(
            "question_id", "tags", "question_score",
            F.lit(None).cast("bigint").alias("answer_id"),
            F.lit(None).cast("int").alias("answer_score"),
        )
    )
    return pairs.unionByName(unanswered)


def grouped_counts(postings: DataFrame) -> DataFrame:
    """A1 + A12: number of (question, answer) pairs per answered question id.

    Equals ``count(*)`` over J1 grouped by question id. Each posting is keyed
    once (a question by its id, an answer by its parent) and both kinds are
    counted in one aggregate, so the input is read once and no group is ever
    gathered in one place.
    """
    kind = F.col("posting_type")
    key = F.when(kind == QUESTION, F.col("id")).when(kind == ANSWER, F.col("parent_id"))
    keyed = postings.select(key.alias("question_id"), kind).filter(F.col("question_id").isNotNull())
    n = F.count_if(kind == QUESTION) * F.count_if(kind == ANSWER)
    return keyed.groupBy("question_id").agg(n.alias("n_pairs")).filter(F.col("n_pairs") > 0)
