"""Postings stored by question: equal rows, no shuffle, hot questions spread."""

import pytest

from postclust.operators import joins
from postclust.operators.scoring import best_answer_scores, score_questions
from postclust.sources.stored import store_postings
from postclust.sources.text import POSTING_SCHEMA, parse_postings, read_lines, render_lines

HOT = 3000


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def postings(spark):
    asked = [(1, q, q * 10 if q % 3 else None, None, q % 7, "Java" if q % 2 else None) for q in range(1, 120)]
    copies = [(1, 5, None, None, 1, "Scala"), (1, 1, None, None, 2, "CSS")]
    hot = [(2, 10_000 + i, None, 1, i % 97, None) for i in range(HOT)]
    cold = [(2, 100_000 + q, None, q, -q, None) for q in range(2, 100)]
    other = [(2, 7, None, None, 3, None), (3, 8, None, 5, 3, None), (2, 9, None, 999, 3, None)]
    return spark.createDataFrame(asked + copies + hot + cold + other, POSTING_SCHEMA).repartition(6)


@pytest.fixture(scope="module", params=[1e-4, 0.1, 2.0], ids=["all hot", "one hot", "none hot"])
def stored(postings, request):
    store = store_postings(postings, buckets=5, share=request.param, salts=4)
    yield store
    store.drop()


def test_same_rows(postings, stored):
    assert rows(stored.pairs()) == rows(joins.join_pairs(postings))
    assert rows(stored.left_pairs()) == rows(joins.left_join_questions(postings))
    assert rows(stored.best_scores()) == rows(best_answer_scores(postings))
    assert rows(stored.scored()) == rows(score_questions(postings))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_shuffle(spark, stored):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (stored.pairs(), stored.left_pairs()):
            assert "SortMergeJoin" in plan_of(df) and "Exchange" not in plan_of(df)
        cold = stored.best_scores().union(stored.scored().select("question_id", "high_score"))
        for line in plan_of(cold).splitlines():  # only a hot question's rows, one a salt, are shuffled
            assert "Exchange" not in line or "hashpartitioning(question_id" in line
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_question_is_spread(spark, postings):
    store = store_postings(postings, buckets=8, share=0.1, salts=16)
    salts = store.answers().where("question_id = 1").groupBy("salt").count().collect()
    assert len(salts) == 16 and max(r["count"] for r in salts) < HOT / 8
    assert store.answers().where("question_id <> 1").select("salt").distinct().collect() == [(0,)]
    store.drop()


def test_text_is_read_once(spark, postings, tmp_path):
    """All of J1, J2, A2, A3 from one scan of the text."""
    render_lines(postings).write.text(str(tmp_path / "lines"))
    parsed = parse_postings(read_lines(spark, str(tmp_path / "lines"))).postings
    store = store_postings(parsed, buckets=3)
    for df in (store.pairs(), store.left_pairs(), store.best_scores(), store.scored()):
        assert "FileScan text" not in plan_of(df)
    assert rows(store.left_pairs()) == rows(joins.left_join_questions(postings))
    store.drop()
    # and the fold of A3 by itself
    assert plan_of(score_questions(parsed)).count("FileScan text") == 1


def test_empty(spark):
    store = store_postings(spark.createDataFrame([], POSTING_SCHEMA), buckets=2)
    assert rows(store.left_pairs()) == rows(store.scored()) == rows(store.best_scores()) == []
    store.drop()
