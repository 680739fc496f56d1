"""Posting lines: text scan (S1), parser (S2), bad-record handling (S3), and
the inverse rendering of postings as lines.

A posting line is ``posting_type,id,[accepted_answer],[parent_id],score[,tags]``
with no header and no quoting. The parser is a single projection of built-in
expressions, so it runs inside whole-stage codegen and splits like any scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSTING_SCHEMA = T.StructType([
    T.StructField("posting_type", T.IntegerType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("accepted_answer", T.LongType(), True),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("score", T.IntegerType(), False),
    T.StructField("tags", T.StringType(), True),
])

POSTING_COLUMNS = [f.name for f in POSTING_SCHEMA.fields]

# --- Fixed values: line format -------------------------------------------------
FIELD_SEPARATOR = ","
INT_PATTERN = r"\A[+-]?[0-9]+\z"   # whole-field signed decimal integer
# -----------------------------------------------------------------------------

# Why a line is bad, in the order of the checks.
BAD_REASONS = tuple(f"{field}: {what}" for field in ("posting_type", "id", "accepted_answer", "parent_id", "score")
                    for what in ("missing", "not an int"))

MODES = ("failfast", "quarantine", "drop")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line (``value STRING``); splittable for plain text."""
    return spark.read.text(path)


def _field(parts: Column, i: int) -> Column:
    return F.get(parts, i)  # NULL when the line has fewer fields


def _is_int(text: Column, sql_type: str) -> Column:
    return text.rlike(INT_PATTERN) & text.try_cast(sql_type).isNotNull()


def _split_fields(lines: DataFrame, value: Column) -> DataFrame:
    """``(value, parts, no_field)``: the line cut into fields once.

    ``parts`` is a separate projection that later expressions reference many
    times; Catalyst keeps such a non-trivial, shared expression in its own
    projection instead of inlining a copy into every reference.
    """
    trimmed = F.rtrim(value, F.lit(FIELD_SEPARATOR))  # trailing empty fields are not fields
    return lines.select(
        value.alias("value"),
        F.split(trimmed, FIELD_SEPARATOR, -1).alias("parts"),
        # a line made of separators only has no field at all
        ((F.length(trimmed) == 0) & (F.length(value) > 0)).alias("no_field"),
    )


def bad_reason(parts: Column, no_field: Column) -> Column:
    """Why a line is not a posting, or NULL for a good line.

    Fields are checked in order; the first failure is reported, as a
    field-by-field constructor would fail.
    """
    f = [_field(parts, i) for i in range(5)]
    optional_bad = lambda s: (s != "") & ~_is_int(s, "bigint")
    return (
        F.when(no_field | f[0].isNull(), F.lit("posting_type: missing"))
        .when(~_is_int(f[0], "int"), F.lit("posting_type: not an int"))
        .when(f[1].isNull(), F.lit("id: missing"))
        .when(~_is_int(f[1], "bigint"), F.lit("id: not an int"))
        .when(f[2].isNull(), F.lit("accepted_answer: missing"))
        .when(optional_bad(f[2]), F.lit("accepted_answer: not an int"))
        .when(f[3].isNull(), F.lit("parent_id: missing"))
        .when(optional_bad(f[3]), F.lit("parent_id: not an int"))
        .when(f[4].isNull(), F.lit("score: missing"))
        .when(~_is_int(f[4], "int"), F.lit("score: not an int"))
    )


def _as_int(text: Column, sql_type: str) -> Column:
    # the pattern check comes first: a failing string cast is far more
    # expensive than a regex miss, and most fields of a junk line fail
    return F.when(text.rlike(INT_PATTERN), text.try_cast(sql_type))


def _typed_fields(parts: Column) -> list[Column]:
    return [
        _as_int(_field(parts, 0), "int").alias("posting_type"),
        _as_int(_field(parts, 1), "bigint").alias("id"),
        _as_int(_field(parts, 2), "bigint").alias("accepted_answer"),
        _as_int(_field(parts, 3), "bigint").alias("parent_id"),
        _as_int(_field(parts, 4), "int").alias("score"),
        _field(parts, 5).alias("tags"),
    ]


@dataclass
class ParsedLines:
    postings: DataFrame
    bad: DataFrame | None


def parse_postings(lines: DataFrame, mode: str = "failfast", value_col: str = "value") -> ParsedLines:
    """S2 + S3: parse a DataFrame of lines into typed postings.

    * ``failfast``: a bad line fails the job (the error names the line).
    * ``quarantine``: bad lines are returned separately with a reason.
    * ``drop``: bad lines are skipped.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    parsed = parse_records(lines, value_col)
    reason, value = F.col("reason"), F.col("value")
    if mode == "failfast":
        fail = F.raise_error(F.concat(F.lit("bad posting line ("), reason, F.lit("): "), value))
        # a filter above the generator: whatever columns a consumer reads or
        # filters on, every line passes the check
        checked = parsed.filter(F.when(reason.isNotNull(), fail.cast("boolean")).otherwise(F.lit(True)))
        return ParsedLines(checked.select(*POSTING_COLUMNS), None)
    good = parsed.filter(reason.isNull()).select(*POSTING_COLUMNS)
    bad = parsed.filter(reason.isNotNull()).select("value", "reason") if mode == "quarantine" else None
    return ParsedLines(good, bad)


def parse_records(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One parsed record per line: ``(value, reason, posting columns)``, reason NULL for a good line."""
    split = _split_fields(lines, F.col(value_col))
    parts = F.col("parts")
    record = F.struct(F.col("value"), bad_reason(parts, F.col("no_field")).alias("reason"), *_typed_fields(parts))
    # emitted by a generator: filters on the result (the bad-record split, or a
    # caller's ``posting_type = 2``) are not pushed below a generator, so the field
    # checks are compiled once per line instead of being inlined into every
    # pushed-down predicate
    return split.select(F.inline(F.array(record)))


GOOD, BAD = "good", "bad"
RECORD_SCHEMA = "value STRING, reason STRING, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in POSTING_SCHEMA.fields) + ", verdict STRING"


def with_verdict(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Parsed records with their ``verdict``; a good line's text and a bad line's fields are left out."""
    parsed, good = parse_records(lines, value_col), F.col("reason").isNull()
    return parsed.select(
        F.when(~good, F.col("value")).alias("value"), "reason",
        *[F.when(good, F.col(c)).alias(c) for c in POSTING_COLUMNS],
        F.when(good, F.lit(GOOD)).otherwise(F.lit(BAD)).alias("verdict"),
    )


def verdict_metrics() -> list[Column]:
    """Observed metrics: the number of good lines, and of bad ones by reason."""
    return [F.count_if(F.col("reason").isNull()).alias(GOOD),
            *[F.count_if(F.col("reason") == F.lit(r)).alias(r) for r in BAD_REASONS]]


@dataclass
class Quarantined(ParsedLines):
    counts: dict[str, int]  # lines by "good" or the reason they are bad


def quarantine(lines: DataFrame, path: str, value_col: str = "value") -> Quarantined:
    """S3 in one pass: the lines are read and parsed once and written under ``path``, good and
    bad ones apart (partitions by verdict); the postings, the bad lines with their reason, both
    read from there, and the counts that the write observed."""
    spark, seen = lines.sparkSession, Observation()
    with_verdict(lines, value_col).observe(seen, *verdict_metrics()).write.partitionBy("verdict").parquet(path)
    written = spark.read.schema(RECORD_SCHEMA).parquet(path)
    good = written.where(F.col("verdict") == GOOD).select(*POSTING_COLUMNS)
    bad = written.where(F.col("verdict") == BAD).select("value", "reason")
    return Quarantined(good, bad, {k: n for k, n in seen.get.items() if n})


def render_lines(postings: DataFrame) -> DataFrame:
    """Postings back to lines (``value STRING``); empty optional fields stay empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return postings.select(F.concat_ws(FIELD_SEPARATOR, *[text(c) for c in POSTING_COLUMNS]).alias("value"))


def text_lines(df: DataFrame, text_col: str) -> DataFrame:
    """Every line of a text column (whole texts, split on newlines) as ``value``."""
    return df.select(F.explode(F.split(F.col(text_col), "\n", -1)).alias("value"))
