"""S3 in one pass: what is written, counted and scanned, in batch and as a stream."""

import pytest

from postclust.sources.text import BAD_REASONS, GOOD, parse_postings, quarantine, read_lines
from postclust.streaming.postings_stream import read_posting_stream, write_quarantined

LINES = ["1,6,,,50,CSS", "2,17,,10,60", "2,5, 7,3,4", "1,6,,,", "", ",,,", "a,b", "1", "1,x", "1,2,3,z,4", "2,5,,3,4.0", "1,6,,,3000000000,C",
         "1,9,29,,-3,Scala,x", "1,2,,", "1,2,3", "1,2"]


@pytest.fixture()
def folder(spark, tmp_path):
    spark.createDataFrame([(x,) for x in LINES], "value STRING").repartition(3).write.text(str(tmp_path / "in"))
    return tmp_path


def both(parsed):
    return [sorted(map(tuple, df.collect()), key=repr) for df in (parsed.postings, parsed.bad)]


def test_one_pass_equals_two(spark, folder):
    lines = read_lines(spark, str(folder / "in"))
    kept = quarantine(lines, str(folder / "out"))
    two = parse_postings(lines, mode="quarantine")
    assert both(kept) == both(two)
    assert kept.postings.schema.names == two.postings.schema.names
    reasons = [r.reason for r in two.bad.collect()]
    assert set(reasons) <= set(BAD_REASONS)
    assert kept.counts == {GOOD: two.postings.count()} | {r: reasons.count(r) for r in reasons}
    # what follows reads what was written, not the lines
    for df in (kept.postings, kept.bad):
        assert "FileScan text" not in df._jdf.queryExecution().executedPlan().toString()


def test_only_good_only_bad_and_nothing(spark, tmp_path):
    for i, (good, bad) in enumerate([(2, 0), (0, 2), (0, 0)]):
        lines = spark.createDataFrame([(x,) for x in ["1,6,,,50"] * good + ["?"] * bad], "value STRING")
        kept = quarantine(lines, str(tmp_path / str(i)))
        assert (kept.postings.count(), kept.bad.count()) == (good, bad)
        assert sum(kept.counts.values()) == good + bad


def test_stream(spark, folder):
    query = write_quarantined(read_posting_stream(spark, str(folder / "in"), 1), str(folder / "out"), str(folder / "ckpt"))
    query.awaitTermination(120)
    out = spark.read.parquet(str(folder / "out"))
    good, bad = both(parse_postings(read_lines(spark, str(folder / "in")), mode="quarantine"))
    assert sorted(map(tuple, out.where("verdict = 'good'").drop("value", "reason", "verdict").collect()), key=repr) == good
    assert sorted(map(tuple, out.where("verdict = 'bad'").select("value", "reason").collect()), key=repr) == bad
    seen = [p.observedMetrics["lines"] for p in query.recentProgress if "lines" in p.observedMetrics]
    assert sum(row[GOOD] for row in seen) == len(good)
