"""From raw documents to packed training sequences, in stages that each call one
corpus operator on all that the stage before has kept.

Each stage but the last returns the columns of ``documents``. Repeated rows and rows
without ``doc_id`` pass through the stages like any other; a stage on an empty table
returns an empty one; further columns are kept up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postclust.llm.best_fit import pack
from postclust.llm.common import drop_tables, keep_listed, materialize, noted_tables, read_table, row_keyed, ship_package
from postclust.llm.decontaminate import contaminated, contamination
from postclust.llm.language_id import UNDETERMINED, fit, has_letters, predict
from postclust.llm.line_templates import drop_recurring_lines
from postclust.llm.simhash import near_groups


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language can't be told: null texts and those without letters.
    Where no document has a label to learn from, the others stay although nothing names their language."""
    model = fit(docs.select("doc_id", "text", "lang"))
    judged = predict(docs, model)
    told = F.col("lang_pred") != UNDETERMINED if model else has_letters(F.col("row.text"))
    return judged.where(told).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines taken out of ``text`` (``n_chars`` follows); every document stays."""
    kept = drop_recurring_lines(docs).select(*[f"`{c}`" for c in docs.columns])
    return kept.withColumn("n_chars", F.char_length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of least ``doc_id`` (null last)."""
    rows = row_keyed(docs)
    groups = near_groups(rows.select(F.col("key").alias("doc_id"), "row.text")).select(F.col("doc_id").alias("key"), "component_id")
    ids = rows.select("key", F.col("row.doc_id").alias("id"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    firsts = groups.join(ids, "key").groupBy("component_id").agg(F.min(order).alias("first")).select("first.key")
    return keep_listed(rows, materialize(firsts, "firsts"), ["key"]).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of which benchmark items cover a twentieth of the words or more."""
    rows = row_keyed(docs)
    judged = contamination(rows.select(F.col("key").alias("doc_id"), "row.text"), read_table(spark, sf_dir, "benchmark"))
    dirty = materialize(judged.where(contaminated()).select(F.col("doc_id").alias("key")), "contaminated")
    return keep_listed(rows, dirty, ["key"], "left_anti").select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token ids in sequences of at most 2,048."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: SQL can't express the stages (a trained model, a tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole of ``documents``; each writes a table that the next one reads, and
    what it wrote for itself goes after that."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with noted_tables() as own:
            kept = stage(spark, docs, sf_dir)
        docs = materialize(kept, name)
        drop_tables(spark, own)
    return docs
