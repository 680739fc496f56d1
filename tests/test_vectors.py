from pyspark.sql import functions as F

from postclust.operators.scoring import score_questions
from postclust.operators.vectors import vectorize, weigh_points, with_labels
from postclust.params import Params

from fixture_values import FIVE_LANGS


def _by_id(df):
    return {r["question_id"]: (r["x"], r["y"]) for r in df.collect()}


def test_vectorize_default_languages(fixture_postings):
    vec = vectorize(score_questions(fixture_postings), Params())
    assert vec.filter(F.col("x") < 0).count() == 0
    assert _by_id(vec) == {7: (50000, 50), 9: (500000, 150), 10: (50000, 90)}


def test_vectorize_five_languages(fixture_postings):
    vec = vectorize(score_questions(fixture_postings), Params(langs=FIVE_LANGS))
    assert _by_id(vec) == {7: (50000, 50), 9: (200000, 150), 10: (50000, 90)}


def test_unknown_language_is_minus_one(fixture_postings):
    params = Params(langs=("Python", "Java", "Ruby", "CSS"))
    vec = vectorize(score_questions(fixture_postings), params)
    assert _by_id(vec)[9] == (-1, 150)
    dropped = vectorize(score_questions(fixture_postings), params.replace(drop_unknown=True))
    assert sorted(_by_id(dropped)) == [7, 10]


def test_labels_of_unknown_is_first_language(fixture_postings):
    params = Params(langs=("Python", "Java", "Ruby", "CSS"))
    labels = {r["question_id"]: (r["lang_index"], r["lang"])
              for r in with_labels(vectorize(score_questions(fixture_postings), params), params).collect()}
    assert labels[9] == (0, "Python")
    assert labels[7] == (1, "Java")


def test_case_sensitive_exact_match(spark):
    from postclust.sources.text import POSTING_SCHEMA

    rows = [(1, 1, None, None, 0, "java"), (1, 2, None, None, 0, "Java "), (1, 3, None, None, 0, "Java"),
            (2, 11, None, 1, 1, None), (2, 12, None, 2, 1, None), (2, 13, None, 3, 1, None)]
    vec = vectorize(score_questions(spark.createDataFrame(rows, POSTING_SCHEMA)), Params(langs=FIVE_LANGS))
    assert {k: v[0] for k, v in _by_id(vec).items()} == {1: -1, 2: -1, 3: 50000}


def test_weighted_points(fixture_postings):
    vec = vectorize(score_questions(fixture_postings), Params(langs=FIVE_LANGS))
    pts = {(r["x"], r["y"]): r["n"] for r in weigh_points(vec).collect()}
    assert pts == {(50000, 50): 1, (200000, 150): 1, (50000, 90): 1}


def test_one_pass_vectors_equal_the_join(spark, fixture_postings, sf_small):
    from postclust.operators.scoring import score_questions
    from postclust.operators.vectors import score_vectors, vectorize
    from postclust.params import Params
    from postclust.plans.catalog import KNOWN_ONLY, UNKNOWN, WIDE
    from postclust.sources.memory import postings_from_rows
    from postclust.sources.tables import postings_from_tables

    tags = [None, "", "A", "B", "BB", "C", "Z", "é"]
    rows = [(1, i % 9, None, None, i % 5, tags[i * 7 % 8]) for i in range(40)]
    rows += [(2, 100 + i, None, i % 12 if i % 7 else None, i % 11 - 5, None) for i in range(60)] + [(3, 5, None, 5, 99, "A")]
    small = Params(langs=("C", "A", "B"), kernels=3)
    cases = [(postings_from_rows(spark, rows), small), (postings_from_rows(spark, rows), small.replace(drop_unknown=True)),
             (fixture_postings, Params()), *[(postings_from_tables(spark, sf_small), p) for p in (WIDE, UNKNOWN, KNOWN_ONLY)]]
    for postings, params in cases:
        want = sorted(map(tuple, vectorize(score_questions(postings), params).collect()))
        assert sorted(map(tuple, score_vectors(postings, params).collect())) == want


def test_text_input_is_read_once(spark, tmp_path):
    from postclust.operators.joins import grouped_counts
    from postclust.operators.vectors import score_vectors
    from postclust.params import Params
    from postclust.sources.text import parse_postings, read_lines

    path = tmp_path / "postings.csv"
    path.write_text("1,1,,,0,Java\n2,2,,1,5\n")
    postings = parse_postings(read_lines(spark, str(path))).postings
    for frame in (score_vectors(postings, Params()), grouped_counts(postings)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan text") == 1
