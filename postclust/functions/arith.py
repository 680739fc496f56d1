"""Exact integer arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(a: Column, b: Column) -> Column:
    """Integral division truncating toward zero (SQL ``div``) of integer or
    exact decimal operands, BIGINT result."""
    return F.call_function("div", a, b)
