"""Text report of the cluster summary (S5), as a DataFrame of lines.

The report is a DataFrame, so the caller picks the sink (``show``,
``write.text``, ...). It has three header lines and one line per cluster in
summary order; the summary has at most ``kernels`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- Fixed values: report layout ---------------------------------------------
REPORT_HEADER = (
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
)
REPORT_ROW_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"  # median score, language, percent, size
# -----------------------------------------------------------------------------


def report_lines(summary: DataFrame) -> DataFrame:
    """``(line_no, line)``: header lines 1-3, then one line per cluster ordered
    by median score (then cid)."""
    spark = summary.sparkSession
    header = spark.createDataFrame(
        [(i + 1, text) for i, text in enumerate(REPORT_HEADER)], "line_no INT, line STRING"
    )
    order = Window.orderBy("median_score", "cid")
    body = summary.select(
        (F.row_number().over(order) + len(REPORT_HEADER)).cast("int").alias("line_no"),
        F.format_string(REPORT_ROW_FORMAT, "median_score", "lang", "pct", "size").alias("line"),
    )
    return header.unionByName(body)


def print_report(summary: DataFrame) -> None:
    """Console sink: print the report lines (at most ``kernels`` + 3 rows)."""
    for row in report_lines(summary).orderBy("line_no").collect():
        print(row["line"])
