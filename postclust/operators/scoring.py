"""Best answer score per question (A2, A3).

Answers are reduced to their maximum score per question and questions to one row
per id by partial aggregates before the one shuffle on the key, so however many
answers (or copies) a question has, it contributes one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postclust.operators.postings import ANSWER, QUESTION, answers, questions


def best_answer_scores(postings: DataFrame) -> DataFrame:
    """A2 per question id: the best answer score, never below 0."""
    return answers(postings).groupBy("question_id").agg(
        F.greatest(F.lit(0), F.max("answer_score")).alias("high_score")
    )


QUESTION_COLUMNS = ["tags", "question_score", "accepted_answer"]


def question_key():
    """A question's columns as one value; of copies of an id the least stays: the
    smallest tag, then score, then accepted answer (NULLs last)."""
    return F.struct(
        F.col("tags").isNull().alias("tags_null"), "tags", "question_score",
        F.col("accepted_answer").isNull().alias("accepted_null"), "accepted_answer",
    )


def unique_questions(postings: DataFrame) -> DataFrame:
    """One question row per id."""
    return questions(postings).groupBy("question_id").agg(F.min(question_key()).alias("q")).select(
        "question_id", *[F.col(f"q.{c}").alias(c) for c in QUESTION_COLUMNS]
    )


def score_questions(postings: DataFrame) -> DataFrame:
    """A3: ``(question_id, tags, question_score, accepted_answer, high_score)``
    for every answered question.

    Every posting is keyed once (a question by its id, an answer by its parent) and both
    kinds fold in one aggregate, so the input is read once and shuffled once. The partial
    aggregate of each task leaves one row per question id, so an id whose copies or
    answers make up a large share of all rows crosses the shuffle as one row per task
    (the fold sorts locally, as ``min`` over a struct is a sort-based aggregate).
    """
    kind = F.col("posting_type")
    keyed = postings.withColumnRenamed("score", "question_score").select(
        F.when(kind == QUESTION, F.col("id")).when(kind == ANSWER, F.col("parent_id")).alias("question_id"),
        F.when(kind == QUESTION, question_key()).alias("q"),
        F.when(kind == ANSWER, F.col("question_score")).alias("answer_score"),
    ).filter(F.col("question_id").isNotNull())
    folded = keyed.groupBy("question_id").agg(F.min("q").alias("q"), F.max("answer_score").alias("best"))
    return folded.filter(F.col("q").isNotNull() & F.col("best").isNotNull()).select(
        "question_id", *[F.col(f"q.{c}").alias(c) for c in QUESTION_COLUMNS],
        F.greatest(F.lit(0), F.col("best")).alias("high_score"))
