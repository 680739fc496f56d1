from postclust.operators import joins
from postclust.operators.postings import answers, questions
from postclust.operators.scoring import score_questions
from postclust.sources.text import POSTING_SCHEMA


def test_grouping(fixture_postings):
    counts = {r["question_id"]: r["n_pairs"] for r in joins.grouped_counts(fixture_postings).collect()}
    assert counts == {7: 1, 9: 3, 10: 2}


def test_join_pairs(fixture_postings):
    pairs = joins.join_pairs(fixture_postings).collect()
    assert len(pairs) == 6
    assert sorted(r["answer_id"] for r in pairs if r["question_id"] == 9) == [19, 29, 30]


def test_left_join_keeps_unanswered(fixture_postings):
    rows = joins.left_join_questions(fixture_postings).collect()
    assert len(rows) == 9
    unanswered = sorted(r["question_id"] for r in rows if r["answer_id"] is None)
    assert unanswered == [6, 8, 40]


def test_filters(fixture_postings):
    assert sorted(r["question_id"] for r in questions(fixture_postings).collect()) == [6, 7, 8, 9, 10, 40]
    # answers without a parent are dropped
    assert sorted(r["answer_id"] for r in answers(fixture_postings).collect()) == [17, 19, 20, 26, 29, 30]


def test_scored(fixture_postings):
    scored = {r["question_id"]: r["high_score"] for r in score_questions(fixture_postings).collect()}
    assert scored == {7: 50, 9: 150, 10: 90}


def test_negative_answers_clamp_to_zero(spark):
    rows = [(1, 1, None, None, 5, "Java"), (2, 2, None, 1, -4, None), (2, 3, None, 1, -3, None)]
    scored = score_questions(spark.createDataFrame(rows, POSTING_SCHEMA)).collect()
    assert [(r["question_id"], r["high_score"]) for r in scored] == [(1, 0)]


def test_duplicate_question_ids_fold(spark):
    rows = [(1, 1, None, None, 5, "Scala"), (1, 1, None, None, 7, "Java"), (2, 2, None, 1, 9, None)]
    postings = spark.createDataFrame(rows, POSTING_SCHEMA)
    scored = score_questions(postings).collect()
    assert len(scored) == 1 and scored[0]["high_score"] == 9
    # the pair count still sees both question copies, as the plain join does
    assert joins.grouped_counts(postings).collect()[0]["n_pairs"] == 2
    assert joins.join_pairs(postings).count() == 2


def test_duplicate_ids_fold_the_same_in_both_engines(spark, tmp_path):
    """Copies of one order key (NULL priority among them) fold to the same row
    in Spark and in the DuckDB oracle."""
    import datetime

    import duckdb
    import pandas as pd

    from __spark_entry__ import oracle_sql, queries

    ts = datetime.datetime(2020, 1, 1)
    orders = pd.DataFrame({
        "o_orderkey": [1, 1, 1, 2, 2, 3],
        "o_custkey": [1] * 6,
        "o_orderstatus": ["O"] * 6,
        "o_totalprice": [1.0] * 6,
        "o_orderdate": [ts] * 6,
        "o_orderpriority": ["3-MEDIUM", None, "1-URGENT", None, None, "2-HIGH"],
    })
    lineitem = pd.DataFrame({
        "l_orderkey": [1, 1, 2, 3, 9],
        "l_partkey": [1] * 5, "l_suppkey": [1] * 5,
        "l_linenumber": pd.array([1, 2, 1, 1, 1], dtype="int32"),
        "l_quantity": [1.0] * 5, "l_extendedprice": [45000.0, 100.0, 30100.0, 29900.0, 5.0],
        "l_discount": [0.0] * 5, "l_tax": [0.0] * 5,
        "l_returnflag": ["N"] * 5, "l_linestatus": ["O"] * 5, "l_shipdate": [ts] * 5,
    })
    orders.to_parquet(tmp_path / "orders.parquet", coerce_timestamps="us")
    lineitem.to_parquet(tmp_path / "lineitem.parquet", coerce_timestamps="us")

    got = sorted(map(tuple, queries()["q_scored_questions"](spark, str(tmp_path)).collect()), key=repr)
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    want = sorted(con.execute(oracle_sql()["q_scored_questions"]).fetchall(), key=repr)
    assert got == want
    by_id = {r[0]: r for r in got}
    assert by_id[1][1] == "1-URGENT" and by_id[1][4] == 150   # smallest non-NULL tag; best score
    assert by_id[2][1] is None and by_id[2][4] == 1            # only NULL tags
    assert by_id[3][4] == 0                                    # negative best score clamps to 0
