"""In-memory sources (S4): postings or points from driver-side rows.

For fixtures and small examples only; production input comes from files or
tables through ``sources.text`` / ``sources.tables``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from postclust.sources.text import POSTING_SCHEMA


def postings_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """``(posting_type, id, accepted_answer, parent_id, score, tags)`` tuples."""
    return spark.createDataFrame(list(rows), POSTING_SCHEMA)


def points_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """``(x, y)`` vectors, or ``(cid, x, y)`` vectors already assigned to a cluster."""
    rows = list(rows)
    schema = "cid INT, x INT, y INT" if rows and len(rows[0]) == 3 else "x INT, y INT"
    return spark.createDataFrame(rows, schema)
