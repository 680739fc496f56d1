"""Registered queries of the corpus operators over the given tables."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postclust.llm.best_fit import pack
from postclust.llm.common import read_table, ship_package
from postclust.llm.cuckoo import mark_copies
from postclust.llm.decontaminate import contaminated, contamination
from postclust.llm.ego_join import near_vectors
from postclust.llm.filter_audit import audit
from postclust.llm.language_id import identify
from postclust.llm.line_templates import drop_recurring_lines
from postclust.llm.lz_spans import dedup_spans
from postclust.llm.oracle import AUDIT, COPIES, DECONTAMINATE, EMBEDDINGS, LINES, SECRETS, SUBSTRINGS, VARIANTS
from postclust.llm.secrets import count_of, scan, spans_text
from postclust.llm.simhash import near_groups
from postclust.llm.token_counts import token_counts
from postclust.llm.variants import spelling_variants
from postclust.llm.wavelet import round_trip


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), payload={"ids_crc32": F.crc32("ids")})


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    return scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *[count_of(spans, kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(spans_text(spans), 256).alias("base_sha256"), spans_text(spans).alias("spans"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["begin"])
    return dedup_spans(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", removed.cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(read_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def shipped(query):
    """The query, after a look whether the executors can import the operators."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: shipped(f) for f in (
    op1_token_counts, op2_best_fit_packing, op3_benchmark_decontamination, op4_simhash_near_dedup, op5_token_id_output,
    op6_secret_scans, op7_language_id, op8_embedding_near_dedup,
    op9_substring_dedup, op10_line_dedup, op11_exact_dedup, op12_spelling_variants,
    op13_filter_interaction_audit,
)}
ORACLE = {
    "op3_benchmark_decontamination": DECONTAMINATE,
    "op6_secret_scans": SECRETS,
    "op8_embedding_near_dedup": EMBEDDINGS,
    "op9_substring_dedup": SUBSTRINGS,
    "op10_line_dedup": LINES,
    "op11_exact_dedup": COPIES,
    "op12_spelling_variants": VARIANTS,
    "op13_filter_interaction_audit": AUDIT,
}
