"""Postings stored by question, so that joins and folds on the question need no shuffle.

``store_postings`` keeps parsed postings as one table, bucketed and sorted by question id
and salt. The salt of a question that holds more than ``HOT_KEY_SHARE`` of all answers
spreads its answers over ``SALT_BUCKETS`` buckets, and its question rows stand in each of
these; all others have salt 0. The input (text, say) is read once: it is cut from its
lineage, and both the count per question and the table are made from that copy.

Layout: partitions ``kind`` (question, answer) and ``hot``, buckets by ``(question_id, salt)``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postclust.operators.joins import HOT_KEY_SHARE, PAIR_COLUMNS, SALT_BUCKETS
from postclust.operators.postings import ANSWER, QUESTION
from postclust.operators.scoring import QUESTION_COLUMNS, question_key
from postclust.session import cut_lineage, ensure_checkpoint_dir

KEY = ["question_id", "salt"]
COLUMNS = ["id", "accepted_answer", "score", "tags"]


def store_postings(postings: DataFrame, table: str | None = None, buckets: int | None = None,
                   share: float = HOT_KEY_SHARE, salts: int = SALT_BUCKETS) -> StoredPostings:
    """Questions and answers with a parent, as table ``table`` (a name of its own if not given) in
    the session's shared folder, or the warehouse if there is none."""
    spark = postings.sparkSession
    table = table or f"postings_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = F.when(F.col("posting_type") == QUESTION, "question").when(F.col("posting_type") == ANSWER, "answer")
    key = F.when(F.col("posting_type") == QUESTION, F.col("id")).otherwise(F.col("parent_id"))
    keyed = postings.select(kind.alias("kind"), key.alias("question_id"), *COLUMNS)
    keyed = cut_lineage(keyed.where("kind IS NOT NULL AND question_id IS NOT NULL"))

    counts = keyed.where("kind = 'answer'").groupBy("question_id").count()
    total = counts.agg((F.sum("count") * F.lit(share)).alias("t")).scalar()
    hot = F.broadcast(counts.where(F.col("count") > total).select("question_id", F.lit(True).alias("hot")))  # at most 1 / share rows
    marked = keyed.join(hot, "question_id", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    own = F.array(F.pmod(F.xxhash64(*COLUMNS), F.lit(salts)).cast("int"))
    salt = F.when(~F.col("hot"), F.array(F.lit(0))).when(F.col("kind") == "question", every).otherwise(own)
    rows = marked.withColumn("salt", F.explode(salt)).repartition(buckets, *KEY)  # a task holds the rows of one bucket
    writer = rows.write.partitionBy("kind", "hot").bucketBy(buckets, *KEY).sortBy(*KEY)
    if folder := ensure_checkpoint_dir(spark):
        writer = writer.option("path", f"{folder}/{table}")
    writer.saveAsTable(table)
    return StoredPostings(spark, table)


@dataclass
class StoredPostings:
    spark: SparkSession
    table: str

    def _rows(self, kind: str) -> DataFrame:
        return self.spark.table(self.table).where(F.col("kind") == kind)

    def questions(self) -> DataFrame:
        """Question rows, those of hot questions once a salt."""
        return self._rows("question").select(*KEY, "hot", "tags", F.col("score").alias("question_score"), "accepted_answer")

    def answers(self) -> DataFrame:
        return self._rows("answer").select(*KEY, "hot", F.col("id").alias("answer_id"), F.col("score").alias("answer_score"))

    def pairs(self) -> DataFrame:
        """J1 without a shuffle: both sides are bucketed by the join's key."""
        return self.answers().drop("hot").join(self.questions().drop("hot"), KEY).select(*PAIR_COLUMNS)

    def left_pairs(self) -> DataFrame:
        """J2 without a shuffle. A hot question has answers, so the others suffice for the unanswered."""
        alone = self.questions().where("NOT hot").join(self.answers().where("NOT hot").select(*KEY), KEY, "left_anti")
        none = [F.lit(None).cast(t).alias(c) for c, t in (("answer_id", "bigint"), ("answer_score", "int"))]
        return self.pairs().unionByName(alone.select("question_id", "tags", "question_score", *none))

    def best_scores(self) -> DataFrame:
        """A2: folded within the buckets; of a hot question at most one row a salt is shuffled."""
        best = F.greatest(F.lit(0), F.max("answer_score")).alias("high_score")
        cold = self.answers().where("NOT hot").groupBy(*KEY).agg(best)
        hot = self.answers().where("hot").groupBy(*KEY).agg(F.max("answer_score").alias("answer_score")).groupBy("question_id").agg(best)
        return cold.select("question_id", "high_score").unionByName(hot)

    def scored(self) -> DataFrame:
        """A3: as ``score_questions``, without a shuffle but for hot questions (a row a salt)."""
        best = F.greatest(F.lit(0), F.max("answer_score")).alias("high_score")
        asked = self.questions().groupBy("hot", *KEY).agg(F.min(question_key()).alias("q"))
        cold = asked.where("NOT hot").join(self.answers().where("NOT hot").groupBy(*KEY).agg(best), KEY)
        hot = self.answers().where("hot").groupBy(*KEY).agg(F.max("answer_score").alias("answer_score")).groupBy("question_id").agg(best)
        hot = asked.where("hot AND salt = 0").join(hot, "question_id")
        out = ["question_id", *[F.col(f"q.{c}").alias(c) for c in QUESTION_COLUMNS], "high_score"]
        return cold.select(*out).unionByName(hot.select(*out))

    def drop(self) -> None:
        """Take the table out of the catalog (files outside the warehouse stay)."""
        self.spark.sql(f"DROP TABLE IF EXISTS `{self.table}`")
