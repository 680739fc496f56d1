import bisect
import random

import pytest
from pyspark.sql import functions as F

from postclust.functions.geometry import envelope, nearest_center, nearest_center_sql, total_shift
from postclust.operators.kmeans import assign, cluster_means, fit, kmeans_step, trace_frame
from postclust.operators.scoring import score_questions
from postclust.operators.summary import cluster_results, lang_stats_of_assigned, summarize_clusters, weighted_medians
from postclust.operators.vectors import vectorize, weigh_points
from postclust.params import Params

from fixture_values import FIVE_LANGS

PARAMS = Params(langs=FIVE_LANGS)
MEANS = [(0, 0, 10), (1, 50000, 30), (2, 100000, 40), (3, 150000, 100), (4, 200000, 100)]


@pytest.fixture(scope="module")
def vectors(fixture_postings):
    return vectorize(score_questions(fixture_postings), PARAMS)


def test_cluster_vector(vectors):
    got = sorted((r["cid"], r["x"], r["y"]) for r in assign(vectors, MEANS).collect())
    assert got == [(1, 50000, 50), (1, 50000, 90), (4, 200000, 150)]


def test_equal_distance_goes_to_lowest_cid(spark):
    pts = spark.createDataFrame([(0, 0)], "x INT, y INT")
    centers = [(0, 10, 0), (1, 0, 0), (2, 0, 0)]  # distance 100 from 0, 0 from both 1 and 2
    assert assign(pts, centers).collect()[0]["cid"] == 1
    pts = spark.createDataFrame([(5, 0)], "x INT, y INT")  # 25 from all three
    assert assign(pts, centers).collect()[0]["cid"] == 0
    centers = [(0, 0, 5), (1, 0, -5)]
    assert assign(spark.createDataFrame([(0, 0)], "x INT, y INT"), centers).collect()[0]["cid"] == 0


def test_non_contiguous_cids(spark):
    pts = spark.createDataFrame([(0, 0), (10, 0)], "x INT, y INT")
    got = sorted(r["cid"] for r in assign(pts, [(3, 0, 0), (7, 10, 0)]).collect())
    assert got == [3, 7]
    with pytest.raises(ValueError):
        nearest_center_sql("x", "y", [(7, 10, 0), (3, 0, 0)])


def test_fit_from_fixture_means(vectors):
    result = fit(weigh_points(vectors), MEANS, PARAMS)
    assert result.centers == [(0, 0, 10), (1, 50000, 70), (2, 100000, 40), (3, 150000, 100), (4, 200000, 150)]
    assert result.iterations == 2 and result.converged
    totals = sorted({row[7] for row in result.trace})
    assert totals == [0.0, 4100.0]


def test_weighted_equals_unweighted(vectors):
    a = fit(weigh_points(vectors), MEANS, PARAMS)
    b = fit(vectors, MEANS, PARAMS)
    assert a.centers == b.centers and a.iterations == b.iterations


def test_empty_cluster_keeps_mean(vectors):
    far = MEANS + [(5, 9_000_000, 9_000_000)]
    moved = kmeans_step(weigh_points(vectors), far)
    assert moved[5] == (5, 9_000_000, 9_000_000)
    assert moved[0] == (0, 0, 10)  # also empty


def test_duplicate_centers_twin_stays_empty(vectors):
    twins = [(0, 50000, 50), (1, 50000, 50), (2, 200000, 150)]
    moved = kmeans_step(weigh_points(vectors), twins)
    assert moved[1] == (1, 50000, 50)           # the twin attracts nothing and keeps its mean
    assert moved[0] == (0, 50000, 70)
    summary = cluster_results(weigh_points(vectors), twins, PARAMS).collect()
    assert sorted(r["cid"] for r in summary) == [0, 2]  # no row for the empty twin


def test_max_iterations_stops_unconverged(vectors):
    result = fit(weigh_points(vectors), MEANS, PARAMS.replace(max_iterations=1))
    assert result.iterations == 1 and not result.converged
    assert result.centers[4] == (4, 200000, 150)  # the new means are returned


def test_trace_frame(spark, vectors):
    result = fit(weigh_points(vectors), MEANS, PARAMS)
    tr = trace_frame(spark, result)
    assert tr.count() == 2 * len(MEANS)
    last = [r for r in tr.collect() if r["it"] == 2]
    assert all(r["converged"] for r in last)


def test_centroid_truncates_toward_zero(spark):
    pts = spark.createDataFrame([(-1, -3), (-1, -4), (0, 0)], "x INT, y INT")
    moved = kmeans_step(pts, [(0, -1, -3)])
    # sums: x = -2, y = -7 over 3 points -> -2 div 3 = 0, -7 div 3 = -2
    assert moved == [(0, 0, -2)]


def test_total_shift_requires_equal_lengths():
    with pytest.raises(ValueError):
        total_shift([(0, 0)], [(0, 0), (1, 1)])


def test_cluster_results_fixture(vectors):
    result = fit(weigh_points(vectors), MEANS, PARAMS)
    rows = [tuple(r)[1:] for r in cluster_results(weigh_points(vectors), result.centers, PARAMS).collect()]
    assert rows == [("Java", 100.0, 2, 70), ("Scala", 100.0, 1, 150)]


ASSIGNED = [
    (1, 50000, 50), (1, 50000, 60), (1, 50000, 60), (1, 0, 90), (1, 0, 70), (1, 0, 60), (1, 0, 60),
    (2, 100000, 70), (2, 100000, 80), (2, 200000, 30), (3, 200000, 9),
]


def test_calculate_median(spark):
    from postclust.sources.memory import points_from_rows

    assigned = points_from_rows(spark, ASSIGNED)
    rows = {r["cid"]: (r["lang"], r["pct"], r["size"], r["median_score"])
            for r in summarize_clusters(lang_stats_of_assigned(assigned), PARAMS).collect()}
    assert rows[1] == ("Python", 57.142857142857146, 7, 65)
    assert rows[2] == ("Ruby", 66.66666666666667, 3, 75)
    assert rows[3] == ("Scala", 100.0, 1, 9)


def test_median_of_negatives_truncates(spark):
    assigned = spark.createDataFrame([(0, 0, -4), (0, 0, -3)], "cid INT, x INT, y INT")
    assert summarize_clusters(lang_stats_of_assigned(assigned), PARAMS).collect()[0]["median_score"] == -3


def test_dominant_tie_goes_to_smaller_x(spark):
    assigned = spark.createDataFrame([(0, 50000, 1), (0, 0, 2)], "cid INT, x INT, y INT")
    row = summarize_clusters(lang_stats_of_assigned(assigned), PARAMS).collect()[0]
    assert (row["lang"], row["pct"], row["median_score"]) == ("Python", 50.0, 2)


def test_weighted_summary_equals_unweighted(spark):
    assigned = spark.createDataFrame(ASSIGNED, "cid INT, x INT, y INT")
    weighted = assigned.groupBy("cid", "x", "y").count().withColumnRenamed("count", "n")
    a = sorted(map(tuple, summarize_clusters(lang_stats_of_assigned(assigned), PARAMS).collect()))
    b = sorted(map(tuple, summarize_clusters(lang_stats_of_assigned(weighted), PARAMS).collect()))
    assert a == b


def test_step_matches_grouped_means(spark, sf_small):
    from postclust.operators.sampling import initial_centers
    from postclust.plans.analysis import prepare_points
    from postclust.plans.catalog import WIDE, _vectors

    vec = _vectors(spark, sf_small, WIDE)
    init = initial_centers(vec, WIDE)
    pts = prepare_points(vec)
    # the same means from literal centers and plain sums
    sums = assign(pts, init).groupBy("cid").agg({"n": "sum"}).collect()
    assert {r["cid"]: r["sum(n)"] for r in sums} == {r["pos"]: r["size"] for r in cluster_means(pts, init).collect()}
    assert [c for c, _, _ in kmeans_step(pts, init)] == [c for c, _, _ in init]
    # one-partition points: the step is a single stage without exchange
    plan = cluster_means(pts, init)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_step_code_does_not_change_with_the_centers(spark, vectors):
    """The break points are constants that the code refers to, so a fit compiles once."""
    import re

    pts = weigh_points(vectors).coalesce(1).persist()
    pts.count()
    codes = set()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the code is there before the plan runs
    try:
        for moved in (0, 7):
            df = cluster_means(pts, [(c, x + moved, y) for c, x, y in MEANS], [0, 50000, 200000])
            parts = df._jdf.queryExecution().debug().codegenToSeq()
            codes.add(tuple(re.sub(r"/\*.*?\*/|#\d+L?", "", parts.apply(i)._2()) for i in range(parts.size())))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(codes) == 1 and codes != {()}


def brute_nearest(x, y, centers):
    return min(range(len(centers)), key=lambda i: ((x - centers[i][0]) ** 2 + (y - centers[i][1]) ** 2, i))


def test_envelope_against_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        reach = rng.choice([2, 9, 200])
        centers = [(rng.choice([0, 5, -3]), rng.randint(-reach, reach)) for _ in range(rng.randint(1, 30))]
        for x in (-1, 0, 5):
            found = envelope(centers, x)
            starts = [s for s, _ in found]
            assert starts == sorted(set(starts)) and len(found) <= len(centers)
            for y in range(-reach - 3, reach + 4):
                assert found[bisect.bisect_right(starts, y) - 1][1] == brute_nearest(x, y, centers), (centers, x, y)


@pytest.mark.parametrize("k", [1, 2, 3, 15, 45])
def test_interval_search_against_brute_force(spark, k):
    rng = random.Random(k)
    limit = 2**31 - 1
    centers = [(i, rng.choice([-1, 0, 100, limit]), rng.choice([rng.randint(-20, 20), limit, -limit])) for i in range(k)]
    pts = [(rng.choice([-1, 0, 100, limit]), y) for y in [*range(-25, 25), limit, -limit, 0] for _ in range(3)]
    got = assign(spark.createDataFrame(pts, "x INT, y INT"), centers).collect()
    assert len(got) == len(pts)
    assert all(r["cid"] == brute_nearest(r["x"], r["y"], [c[1:] for c in centers]) for r in got)


def test_interval_search_agrees_with_the_definition(spark, vectors):
    pts = weigh_points(vectors)
    for centers in (MEANS, [(0, 50000, 50), (1, 50000, 50), (2, 200000, 150)], [(3, 0, 0), (7, 50000, 70)]):
        a = sorted((r["x"], r["y"], r["cid"]) for r in assign(pts, centers).collect())
        b = sorted(map(tuple, pts.select("x", "y", nearest_center("x", "y", centers)).collect()))
        assert a == b


def test_centroid_sums_beyond_bigint(spark):
    big = 2_000_000_000
    pts = spark.createDataFrame([(big, 1, 10**10), (big, 4, 10**10)], "x INT, y INT, n BIGINT")
    # x * n summed is 4e19, past the BIGINT range
    assert kmeans_step(pts, [(0, big, 0)]) == [(0, big, 2)]
    row = cluster_means(pts, [(0, big, 0)]).collect()[0]
    assert (row["mx"], row["my"], row["size"]) == (big, 2, 2 * 10**10)


def test_weighted_medians_against_percentile(spark):
    rng = random.Random(9)
    spread = [1, 50, 70_000, 2**31 - 1]
    rows = [(g, rng.randint(-spread[g], spread[g]), rng.choice([1, 1, 2, 7])) for g in range(4) for _ in range(rng.choice([1, 40, 41]))]
    rows += [(5, -3, 1), (5, -4, 1), (6, -2**31, 3), (6, 2**31 - 1, 3), (7, 0, 10**12), (7, 9, 1)]
    df = spark.createDataFrame(rows, "g INT, v INT, w BIGINT").repartition(4)
    want = df.groupBy("g").agg(F.sum("w"), F.expr("CAST(percentile(v, 0.5D, w) AS INT)"))
    got = weighted_medians(df, ["g"], "v", "w")
    assert got.columns == ["g", "total", "median"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan  # no list or counter of a whole group's values
