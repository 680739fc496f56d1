"""Postings derived from the TPC-H-like driver tables.

There is no posting file among the driver tables, so a fixed mapping turns them
into postings: every order is a question tagged with its priority, every line
item is an answer to its order scored from its price. By their keys some orders
name an accepted answer or repeat another question's id, and some line items lack
a parent or are of another type. All queries of the library read postings through this mapping, so their work grows with the
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postclust.params import Params

# --- Fixed values: mapping of the driver tables onto postings ----------------
# Tags of the questions are the order priorities; these are their "languages",
# in index order.
PRIORITY_LANGS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
ANSWER_ID_FACTOR = 10      # answer id = l_orderkey * 10 + l_linenumber
SCORE_PRICE_UNIT = 100     # answer score = floor(l_extendedprice / 100) - 300
SCORE_OFFSET = 300
QUESTION_SCORES = 41       # question score = o_orderkey % 41 - 20
QUESTION_SCORE_OFFSET = 20
ACCEPTED_EVERY = 4         # orders whose first line item is the accepted answer
REPEATED_EVERY = 50        # orders that repeat the question id before theirs
ORPHAN_EVERY = 97          # line items (by answer id) without a parent
OTHER_TYPE_EVERY = 89      # line items (by answer id) of another posting type
OTHER_TYPE = 3
# -----------------------------------------------------------------------------

# Parameters of the analysis over the driver tables: 5 languages x 3 = 15 centers.
TABLE_PARAMS = Params(langs=PRIORITY_LANGS, kernels=15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def question_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return read_table(spark, sf_dir, "orders").select(
        F.lit(1).alias("posting_type"),
        F.when(key % REPEATED_EVERY == 0, key - 1).otherwise(key).alias("id"),
        F.when(key % ACCEPTED_EVERY == 0, key * ANSWER_ID_FACTOR + 1).cast("bigint").alias("accepted_answer"),
        F.lit(None).cast("bigint").alias("parent_id"),
        (key % QUESTION_SCORES - QUESTION_SCORE_OFFSET).cast("int").alias("score"),
        F.col("o_orderpriority").alias("tags"),
    )


def answer_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey") * ANSWER_ID_FACTOR + F.col("l_linenumber")
    return read_table(spark, sf_dir, "lineitem").select(
        F.when(key % OTHER_TYPE_EVERY == 0, OTHER_TYPE).otherwise(2).alias("posting_type"),
        key.alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.when(key % ORPHAN_EVERY != 0, F.col("l_orderkey")).alias("parent_id"),
        (F.floor(F.col("l_extendedprice") / SCORE_PRICE_UNIT).cast("int") - SCORE_OFFSET).alias("score"),
        F.lit(None).cast("string").alias("tags"),
    )


def postings_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All postings: questions from ``orders`` and answers from ``lineitem``.

    A filter on ``posting_type`` above this union reaches both scans; in the
    branch of the questions it folds.
    """
    return question_postings(spark, sf_dir).unionByName(answer_postings(spark, sf_dir))
