"""Posting lines arriving as files (S1-S3 on Structured Streaming).

The parser is a stateless projection, so the same expressions run on a file
stream: new files under a folder become micro-batches of typed postings, and
bad lines go to their own sink with the reason. Nothing here keeps state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postclust.sources.text import ParsedLines, parse_postings, verdict_metrics, with_verdict


def read_posting_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 as a stream: one row (``value``) per line of every new text file."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)


def parse_posting_stream(lines: DataFrame, mode: str = "quarantine") -> ParsedLines:
    """S2 + S3 on a streaming DataFrame of lines (same modes as the batch parser)."""
    return parse_postings(lines, mode=mode)


def write_parsed(parsed: ParsedLines, out_folder: str, checkpoint_folder: str,
                 available_now: bool = True) -> list[StreamingQuery]:
    """Append good postings and (in quarantine mode) bad lines as parquet.

    Each sink has its own checkpoint under ``checkpoint_folder``, which must be
    on shared storage on a cluster, so a restarted query resumes where it left.
    """
    queries = []
    for name, df in (("postings", parsed.postings), ("bad", parsed.bad)):
        if df is None:
            continue
        writer = (
            df.writeStream.format("parquet")
            .option("path", f"{out_folder}/{name}")
            .option("checkpointLocation", f"{checkpoint_folder}/{name}")
            .outputMode("append")
        )
        if available_now:
            writer = writer.trigger(availableNow=True)
        queries.append(writer.start())
    return queries


def write_quarantined(lines: DataFrame, out_folder: str, checkpoint_folder: str, available_now: bool = True) -> StreamingQuery:
    """S3 in one query: every line is read and parsed once and appended under ``out_folder``, good
    and bad ones apart (partitions by ``verdict``). The progress of the query has the counts of
    good lines and of bad ones by reason as observed metrics ``lines``."""
    parsed = with_verdict(lines).observe("lines", *verdict_metrics())
    writer = (
        parsed.writeStream.format("parquet")
        .partitionBy("verdict")
        .option("path", out_folder)
        .option("checkpointLocation", checkpoint_folder)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
