"""Spark operators against the plain-Python models of ``brute.py`` on generated
inputs (parser verdicts and values, fit, cluster summary)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import brute
from postclust.operators.kmeans import fit
from postclust.operators.summary import cluster_results
from postclust.params import Params
from postclust.sources.text import parse_postings

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))

field = st.one_of(
    st.sampled_from(["", "0", "7", "-3", "+4", "12", " 5", "4.0", "x", "2147483648", "-2147483649", "7\r", "\t7",
                     "7\n", "-0", "٣",
                     "9223372036854775807", "9223372036854775808", "007", "+", "-", "Java", '"C#"']),
    st.text(alphabet="0123456789+-a ,", max_size=6),
)
line = st.lists(field, min_size=0, max_size=8).map(lambda fs: ",".join(fs))


@SETTINGS
@given(st.lists(line, min_size=1, max_size=40))
def test_parser_matches_model(spark, lines):
    df = spark.createDataFrame([(l,) for l in lines], "value STRING")
    parsed = parse_postings(df, mode="quarantine")
    got_good = sorted(map(tuple, parsed.postings.collect()), key=repr)
    got_bad = sorted(((r["value"], r["reason"]) for r in parsed.bad.collect()), key=repr)
    want_good, want_bad = [], []
    for l in lines:
        posting, reason = brute.parse_line(l)
        if reason is None:
            want_good.append(posting)
        else:
            want_bad.append((l, reason))
    assert got_good == sorted(want_good, key=repr)
    assert got_bad == sorted(want_bad, key=repr)


LANGS = ("a", "b", "c", "d")
SPREAD = 1000

vectors_st = st.lists(
    st.tuples(st.sampled_from([-1, 0, 1000, 2000, 3000]), st.integers(min_value=-50, max_value=400)),
    min_size=1, max_size=60,
)
means_st = st.lists(
    st.tuples(st.sampled_from([0, 1000, 2000, 3000]), st.integers(min_value=-50, max_value=400)),
    min_size=1, max_size=6,
)


@SETTINGS
@given(vectors_st, means_st, st.sampled_from([0.5, 20.0, 5000.0]), st.integers(min_value=1, max_value=8))
def test_fit_and_summary_match_model(spark, vectors, means, eta, max_iterations):
    params = Params(langs=LANGS, spread=SPREAD, kernels=4, eta=eta, max_iterations=max_iterations)
    df = spark.createDataFrame(vectors, "x INT, y INT")
    weighted = df.groupBy("x", "y").count().withColumnRenamed("count", "n")
    init = [(i, x, y) for i, (x, y) in enumerate(means)]

    want_means, want_it, want_conv = brute.kmeans(vectors, means, eta, max_iterations)
    got = fit(weighted, init, params)
    assert [(x, y) for _, x, y in got.centers] == want_means
    assert (got.iterations, got.converged) == (want_it, want_conv)

    want = brute.cluster_summary(vectors, want_means, LANGS, SPREAD)
    rows = cluster_results(weighted, got.centers, params).collect()
    assert {r["cid"]: (r["lang"], r["pct"], r["size"], r["median_score"]) for r in rows} == want
    assert [r["median_score"] for r in rows] == sorted(r["median_score"] for r in rows)
