import pytest
from pyspark.sql import functions as F

from postclust.operators.sampling import (
    SampleError, initial_centers, sample_fraction, sample_global, sample_per_language, seed_sample,
)
from postclust.params import Params
from postclust.plans.catalog import NARROW, WIDE, _vectors

from fixture_values import FIVE_LANGS


@pytest.fixture(scope="module")
def vec(spark, sf_small):
    return _vectors(spark, sf_small, WIDE).persist()


def test_per_language_sample_shape(vec):
    s = sample_per_language(vec, WIDE)
    counts = {r["x"]: r["count"] for r in s.groupBy("x").count().collect()}
    assert counts == {i * WIDE.spread: WIDE.per_lang for i in range(len(WIDE.langs))}
    # a subset of the vectors
    assert s.join(vec, ["question_id", "x", "y"], "left_anti").count() == 0


def test_sample_is_deterministic_and_partition_independent(vec):
    a = sorted(map(tuple, seed_sample(vec, WIDE).collect()))
    b = sorted(map(tuple, seed_sample(vec.repartition(7), WIDE).collect()))
    assert a == b


def test_global_sample(vec):
    s = sample_global(vec, NARROW)
    assert s.count() == NARROW.kernels
    assert s.select("question_id").distinct().count() == NARROW.kernels


def test_initial_centers_ids(vec):
    init = initial_centers(vec, WIDE)
    assert [c for c, _, _ in init] == list(range(WIDE.kernels))
    assert [x for _, x, _ in init] == sorted(x for _, x, _ in init)


def test_missing_language_fails(vec):
    params = WIDE.replace(langs=WIDE.langs + ("6-NONE",), kernels=18)
    with pytest.raises(SampleError):
        initial_centers(vec.filter(F.col("x") >= 0), params)


def test_unknown_group_fails(vec):
    # with only 4 known languages the -1 group is a sixth group: too many samples
    params = WIDE.replace(langs=WIDE.langs[:4], kernels=12)
    unknown = vec.withColumn("x", F.when(F.col("x") == 4 * WIDE.spread, F.lit(-1)).otherwise(F.col("x")))
    with pytest.raises(SampleError):
        initial_centers(unknown, params)


def test_small_group_fails(spark):
    vec = spark.createDataFrame([(1, 0, 5), (2, 0, 6), (3, 50000, 1)], "question_id BIGINT, x INT, y INT")
    with pytest.raises(SampleError, match="fewer than"):
        initial_centers(vec, Params(langs=("a", "b"), kernels=4))


def test_kernels_must_divide():
    with pytest.raises(ValueError):
        Params(langs=FIVE_LANGS, kernels=7).per_lang


def test_bernoulli_sample(vec):
    n = vec.count()
    s = sample_fraction(vec, 0.5, with_replacement=False, seed=3).count()
    assert 0.3 * n < s < 0.7 * n


def test_params_checks():
    with pytest.raises(ValueError):
        Params(spread=0)
    assert Params(langs=FIVE_LANGS, spread=100).global_sample
    assert not Params().global_sample


def test_fraction_samples_do_not_depend_on_partitions(spark):
    from pyspark.sql import functions as F

    from postclust.operators.sampling import poisson_steps, sample_fraction

    vectors = spark.range(4000).select(F.col("id").alias("question_id"), F.lit(1).alias("x"), F.lit(2).alias("y"))
    for replace, fraction in ((False, 0.25), (True, 0.5)):
        one = sorted(r["question_id"] for r in sample_fraction(vectors.coalesce(1), fraction, replace, 3).collect())
        many = sorted(r["question_id"] for r in sample_fraction(vectors.repartition(7), fraction, replace, 3).collect())
        assert one == many
        assert abs(len(one) / 4000 - fraction) < 0.05
        assert (len(set(one)) < len(one)) == replace
    assert abs(poisson_steps(1.0)[-1] - 1) < 1e-12
