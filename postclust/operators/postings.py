"""Question/answer selection.

Both are a filter plus a projection onto the join key, so Catalyst pushes the
type and key predicates into the scan and reads only the needed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUESTION = 1
ANSWER = 2


def questions(postings: DataFrame) -> DataFrame:
    """P2 + P3: questions keyed by their own id."""
    return postings.filter(F.col("posting_type") == QUESTION).select(
        F.col("id").alias("question_id"),
        F.col("tags"),
        F.col("score").alias("question_score"),
        F.col("accepted_answer"),
    )


def answers(postings: DataFrame) -> DataFrame:
    """P1 + P3: answers keyed by the question they answer; orphans dropped."""
    return postings.filter((F.col("posting_type") == ANSWER) & F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("question_id"),
        F.col("id").alias("answer_id"),
        F.col("score").alias("answer_score"),
    )
