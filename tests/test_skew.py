"""One question holding most answers: the joins stay correct and the hot key is
split across tasks instead of landing in one."""

import pytest

from postclust.operators import joins
from postclust.operators.scoring import score_questions
from postclust.sources.text import POSTING_SCHEMA

HOT_ANSWERS = 6000


@pytest.fixture()
def skewed(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    questions = [(1, q, None, None, 0, "Java") for q in range(1, 201)]
    hot = [(2, 10_000 + i, None, 1, i % 97, None) for i in range(HOT_ANSWERS)]
    cold = [(2, 100_000 + q, None, q, q, None) for q in range(2, 201)]
    postings = spark.createDataFrame(questions + hot + cold, POSTING_SCHEMA).repartition(16)
    yield postings
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_question_join_is_split(skewed):
    pairs = joins.join_pairs(skewed)
    plan = _final_plan(pairs)
    assert pairs.count() == HOT_ANSWERS + 199
    assert "SortMergeJoin" in plan and "skew=true" in plan


def test_left_join_with_hot_question(skewed):
    rows = joins.left_join_questions(skewed)
    assert rows.count() == HOT_ANSWERS + 199
    assert rows.filter("answer_id IS NULL").count() == 0


def test_scores_with_hot_question(skewed):
    scored = {r["question_id"]: r["high_score"] for r in score_questions(skewed).collect()}
    assert scored[1] == 96 and len(scored) == 200
    counts = {r["question_id"]: r["n_pairs"] for r in joins.grouped_counts(skewed).collect()}
    assert counts[1] == HOT_ANSWERS


def test_hot_copies_of_one_question(spark):
    copies = [(1, 7, None, None, 0, "Java")] * 5000
    rest = [(1, q, None, None, 0, "Scala") for q in range(8, 60)]
    answers = [(2, 1000 + q, None, q, q, None) for q in range(7, 60)]
    postings = spark.createDataFrame(copies + rest + answers, POSTING_SCHEMA).repartition(8)
    scored = {r["question_id"]: (r["tags"], r["high_score"]) for r in score_questions(postings).collect()}
    assert scored[7] == ("Java", 7) and len(scored) == 53
    plan = score_questions(postings)._jdf.queryExecution().executedPlan().toString()
    # the question copies are folded by a partial aggregate before any exchange
    assert "partial_min" in plan
    counts = {r["question_id"]: r["n_pairs"] for r in joins.grouped_counts(postings).collect()}
    assert counts[7] == 5000


def test_salted_pairs_equal_plain_join(skewed):
    plain = sorted(map(tuple, joins.join_pairs(skewed, salted=False).collect()))
    salted_df = joins.join_pairs(skewed, salted=True)
    assert sorted(map(tuple, salted_df.collect())) == plain
    left = sorted(map(tuple, joins.left_join_questions(skewed, salted=True).collect()), key=repr)
    assert left == sorted(map(tuple, joins.left_join_questions(skewed, salted=False).collect()), key=repr)


def test_salting_spreads_the_hot_question(spark, skewed):
    from pyspark.sql import functions as F

    a = skewed.filter("posting_type = 2 AND parent_id IS NOT NULL").select(
        F.col("parent_id").alias("question_id"), F.col("id").alias("answer_id"), F.col("score").alias("answer_score"))
    q = skewed.filter("posting_type = 1").select(
        F.col("id").alias("question_id"), "tags", F.col("score").alias("question_score"))
    pairs = joins.salted_pairs(a, q, buckets=8)
    per_task = (pairs.filter("question_id = 1").groupBy(F.spark_partition_id().alias("p")).count()
                .collect())
    assert len(per_task) > 1  # the hot question's pairs come out of several tasks


def test_salting_chosen_without_adaptive_skew_join(spark, fixture_postings):
    old = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plan = joins.join_pairs(fixture_postings)._jdf.queryExecution().optimizedPlan().toString()
        assert "salt" in plan
        assert joins.join_pairs(fixture_postings).count() == 6
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", old)
