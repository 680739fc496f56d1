import pytest

from postclust.sources.text import parse_postings, render_lines

# (line, verdict or None for good) -- hand-made lines covering the format rules
LINES = [
    ("1,6,,,50,CSS", None),
    ("2,17,,10,60", None),
    ("2,18,,10,7,", None),
    ("1,9,29,,-3,Scala,x", None),
    ('1,10,,,5,"C#"', None),
    ("2,5,,3,+4", None),
    ("1,6,,,50,,x", None),
    ("2,5, 7,3,4", "accepted_answer: not an int"),
    ("2,5,,3,4.0", "score: not an int"),
    ("1,6,,,", "accepted_answer: missing"),
    ("1,6,,,,CSS", "score: not an int"),
    ("", "posting_type: not an int"),
    (",,,", "posting_type: missing"),
    ("postTypeId,id,a,b,c,d", "posting_type: not an int"),
    ("1,6,,,3000000000,CSS", "score: not an int"),
    ("1", "id: missing"),
    ("1,x", "id: not an int"),
    ("1,2,,z,3", "parent_id: not an int"),
    ("2,5,,3,7\r", "score: not an int"),
    ("2,5,,3,\t7", "score: not an int"),
    ("1,\u0663,,,5", "id: not an int"),
]


def _lines(spark):
    return spark.createDataFrame([(l,) for l, _ in LINES], "value STRING")


def test_quarantine_verdicts(spark):
    parsed = parse_postings(_lines(spark), mode="quarantine")
    bad = {r["value"]: r["reason"] for r in parsed.bad.collect()}
    good = parsed.postings.collect()
    assert bad == {l: v for l, v in LINES if v is not None}
    assert len(good) == sum(1 for _, v in LINES if v is None)


def test_parsed_values(spark):
    parsed = parse_postings(_lines(spark), mode="drop").postings
    rows = {(r["posting_type"], r["id"], r["score"]): r for r in parsed.collect()}
    assert rows[(2, 18, 7)]["tags"] is None            # trailing empty field is not a field
    assert rows[(2, 17, 60)]["tags"] is None
    assert rows[(2, 17, 60)]["parent_id"] == 10
    assert rows[(1, 9, -3)]["tags"] == "Scala"          # extra field ignored
    assert rows[(1, 9, -3)]["accepted_answer"] == 29
    assert rows[(1, 10, 5)]["tags"] == '"C#"'           # no quoting
    assert rows[(2, 5, 4)]["parent_id"] == 3            # '+4' is 4
    assert rows[(1, 6, 50)]["tags"] in ("CSS", "")
    assert {r["tags"] for r in parsed.collect() if r["id"] == 6} == {"CSS", ""}


def test_failfast_raises_on_bad_line(spark):
    parsed = parse_postings(_lines(spark), mode="failfast").postings
    with pytest.raises(Exception, match="bad posting line"):
        parsed.select("id").collect()


def test_failfast_passes_good_lines(spark, fixture_postings):
    back = parse_postings(render_lines(fixture_postings), mode="failfast").postings
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, fixture_postings.collect()))


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse_postings(_lines(spark), mode="lenient")


def test_text_scan(spark, tmp_path):
    from postclust.sources.text import read_lines

    path = tmp_path / "postings.csv"
    path.write_text("\n".join(l for l, v in LINES if v is None) + "\n")
    parsed = parse_postings(read_lines(spark, str(path)), mode="failfast").postings
    assert parsed.count() == sum(1 for _, v in LINES if v is None)


def test_text_scan_windows_line_endings(spark, tmp_path):
    from postclust.sources.text import read_lines

    path = tmp_path / "crlf.csv"
    path.write_bytes(b"1,6,,,50,CSS\r\n2,17,,6,60\r\n")
    rows = parse_postings(read_lines(spark, str(path)), mode="failfast").postings.collect()
    assert sorted((r["id"], r["score"], r["tags"]) for r in rows) == [(6, 50, "CSS"), (17, 60, None)]


FAILING_CONSUMERS = {
    "count": lambda df: df.count(),
    "select score": lambda df: df.select("score").collect(),
    "filter and count": lambda df: df.filter("score > 0").count(),
    "group": lambda df: df.groupBy("score").count().collect(),
    "select two": lambda df: df.select("tags", "parent_id").collect(),
}


@pytest.mark.parametrize("consumer", FAILING_CONSUMERS)
def test_failfast_holds_for_every_consumer(spark, consumer):
    lines = spark.createDataFrame([("1,1,,,5,Java",), ("1,2,,,x,Java",), ("2,3,,1,4",)], "value STRING")
    with pytest.raises(Exception, match="bad posting line"):
        FAILING_CONSUMERS[consumer](parse_postings(lines, mode="failfast").postings)


def test_failfast_compiles_the_checks_once(spark):
    """The guard reads the reason that the generator made; it doesn't repeat the checks."""
    lines = spark.createDataFrame([("1,1,,,5,Java",)], "value STRING")
    plan = parse_postings(lines, mode="failfast").postings._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posting_type: missing") == 1
