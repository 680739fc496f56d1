from postclust.__main__ import main
from postclust.sources.tables import PRIORITY_LANGS, postings_from_tables
from postclust.sources.report import report_lines
from postclust.sources.text import render_lines


def test_cli_report(spark, sf_small, tmp_path, capsys):
    src = tmp_path / "postings"
    render_lines(postings_from_tables(spark, sf_small)).write.text(str(src))
    main([str(src), "--langs", ",".join(PRIORITY_LANGS), "--kernels", "15", "--mode", "quarantine",
          "--bad-out", str(tmp_path / "bad")])
    out = capsys.readouterr().out.splitlines()
    assert out[0].startswith("fit: ") and "converged" in out[0]
    assert out[1] == "Resulting clusters:"
    from postclust.plans.analysis import run_analysis
    from postclust.sources.tables import TABLE_PARAMS

    expected = run_analysis(postings_from_tables(spark, sf_small), TABLE_PARAMS).summary
    lines = [r["line"] for r in report_lines(expected).orderBy("line_no").collect()]
    assert out[1:] == lines
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 0


def test_cli_trace_and_failfast(spark, tmp_path, capsys):
    import pytest

    good = tmp_path / "good.csv"
    lines = [f"1,{q},,,0,{lang}" for q, lang in ((1, "Java"), (2, "Scala"), (3, "Java"))]
    lines += [f"2,{10 + q},,{q},{5 * q},".rstrip(",") for q in (1, 2, 3)]
    good.write_text("\n".join(lines) + "\n")
    main([str(good), "--langs", "Java,Scala", "--kernels", "2", "--spread", "100", "--trace"])
    out = capsys.readouterr().out.splitlines()
    assert any("total_shift" in l for l in out) and any(l.startswith("fit: ") for l in out)
    assert "Resulting clusters:" in out

    bad = tmp_path / "bad.csv"
    bad.write_text("\n".join(lines + ["2,99,,3,4.5"]) + "\n")
    with pytest.raises(Exception, match="bad posting line"):
        main([str(bad), "--langs", "Java,Scala", "--kernels", "2", "--spread", "100"])
