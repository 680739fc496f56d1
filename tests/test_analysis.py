import pytest

from postclust.operators.scoring import score_questions
from postclust.operators.vectors import vectorize
from postclust.plans.analysis import RowCountError, run_analysis
from postclust.sources.report import report_lines
from postclust.sources.tables import TABLE_PARAMS, postings_from_tables


@pytest.fixture(scope="module")
def postings(spark, sf_small):
    return postings_from_tables(spark, sf_small)


@pytest.fixture(scope="module")
def analysis(postings):
    return run_analysis(postings, TABLE_PARAMS)


def test_sizes_cover_all_vectors(postings, analysis):
    n = vectorize(score_questions(postings), TABLE_PARAMS).count()
    assert sum(r["size"] for r in analysis.summary.collect()) == n
    assert analysis.points.agg({"n": "sum"}).collect()[0][0] == n


def test_expected_row_count(postings, analysis):
    n = analysis.points.agg({"n": "sum"}).collect()[0][0]
    run_analysis(postings, TABLE_PARAMS.replace(max_iterations=1), expect_rows=n)
    with pytest.raises(RowCountError):
        run_analysis(postings, TABLE_PARAMS, expect_rows=n + 1)


def test_independent_of_partitioning(postings, analysis):
    other = run_analysis(postings.repartition(11), TABLE_PARAMS)
    assert other.result.centers == analysis.result.centers
    assert sorted(map(tuple, other.summary.collect())) == sorted(map(tuple, analysis.summary.collect()))


def test_points_lineage_is_cut(analysis):
    # the fit input reads checkpoint files, not the parquet tables
    plan = analysis.points._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan.lower()
    assert analysis.points.rdd.getNumPartitions() == 1


def test_report_layout(analysis):
    lines = [r["line"] for r in report_lines(analysis.summary).orderBy("line_no").collect()]
    assert lines[0] == "Resulting clusters:"
    assert lines[2] == "=" * 48
    body = lines[3:]
    assert len(body) == analysis.summary.count()
    assert all(len(l.split("(")[0]) == 27 and "%)" in l for l in body)


def test_print_report(analysis, capsys):
    from postclust.sources.report import print_report

    print_report(analysis.summary)
    out = capsys.readouterr().out.splitlines()
    assert out[0] == "Resulting clusters:" and len(out) == 3 + analysis.summary.count()


def test_multi_partition_points_give_same_fit(postings, analysis, monkeypatch):
    import postclust.plans.analysis as plan

    monkeypatch.setattr(plan, "POINTS_PER_PARTITION", 100)
    split = run_analysis(postings, TABLE_PARAMS)
    assert split.points.rdd.getNumPartitions() > 1
    assert split.result.centers == analysis.result.centers
    assert split.result.iterations == analysis.result.iterations
    assert sorted(map(tuple, split.summary.collect())) == sorted(map(tuple, analysis.summary.collect()))


def test_without_checkpoint_folder(postings, analysis, monkeypatch):
    import postclust.session as session

    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda spark: None)
    monkeypatch.setattr("postclust.plans.analysis.ensure_checkpoint_dir", lambda spark: None)
    cached = run_analysis(postings, TABLE_PARAMS)
    assert cached.result.centers == analysis.result.centers
    assert sorted(map(tuple, cached.summary.collect())) == sorted(map(tuple, analysis.summary.collect()))


def executed(df):
    """The final plan and, apart, what lies below its cached relations."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_stay_cached_until_released(spark, postings, monkeypatch):
    import postclust.session as session

    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda spark: None)
    monkeypatch.setattr("postclust.plans.analysis.ensure_checkpoint_dir", lambda spark: None)
    run = run_analysis(postings, TABLE_PARAMS)
    plan = run.summary._jdf.queryExecution().withCachedData().toString()
    assert "InMemoryRelation" in plan
    assert run.points.storageLevel.useMemory
    physical = executed(run.summary)
    assert "InMemoryTableScan" in physical
    # every scan of a file lies below the cached relation
    above = physical.split("InMemoryRelation")[0]
    assert "FileScan" not in above
    run.release()
    assert not run.points.storageLevel.useMemory
