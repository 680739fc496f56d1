from postclust.sources.text import parse_postings, render_lines
from postclust.sources.tables import postings_from_tables
from postclust.streaming.postings_stream import parse_posting_stream, read_posting_stream, write_parsed


def test_stream_parse_matches_batch(spark, sf_small, tmp_path):
    src = tmp_path / "in"
    lines = render_lines(postings_from_tables(spark, sf_small))
    junk = spark.createDataFrame([("not,a,posting",), ("1,2",), ("",)], "value STRING")
    lines.unionByName(junk).repartition(3).write.text(str(src))

    parsed = parse_posting_stream(read_posting_stream(spark, str(src), max_files_per_trigger=1))
    for q in write_parsed(parsed, str(tmp_path / "out"), str(tmp_path / "ckpt")):
        q.awaitTermination(300)

    good = spark.read.parquet(str(tmp_path / "out" / "postings"))
    bad = spark.read.parquet(str(tmp_path / "out" / "bad"))
    batch = parse_postings(spark.read.text(str(src)), mode="quarantine")
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(map(tuple, batch.postings.collect()), key=repr)
    assert sorted(map(tuple, bad.collect())) == sorted(map(tuple, batch.bad.collect()))
    assert bad.count() == 3
