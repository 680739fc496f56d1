"""Operator 3, benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of ``WINDOW`` words (a shorter item is one window).
A window that occurs in a document needs all its words there, so with the words
ordered by rarity in the corpus a prefix of one, the rarest, is enough to find
every candidate: overlap ``t`` of ``n`` words needs ``n - t + 1`` of them, and
here ``t = n``. A window with a word that the corpus lacks is out at once. The
prefix words meet the document's words, the places where the window would not
fit into the document are left out by its length and the word's position in it,
and the words of the rest are compared one by one.

Windows are broadcast in blocks of at most ``BLOCK_WINDOWS``, each of at most
``WINDOW`` words; more windows mean more passes over the corpus. Corpus words
are never shuffled: what is, are the found places and one narrow row a document.

Edge cases: a null text or one without words has no words, no hits and is not
contaminated; copies and rows that share or lack a ``doc_id`` are judged one by
one; items without words occur nowhere; an item without ``item_id`` marks words
but is not counted or listed, several with one id count once; empty tables give
no hits or no rows; other columns are ignored.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postclust.llm.common import keep_listed, materialize

WINDOW = 13

#: Windows of the benchmark compared in one pass over the corpus.
BLOCK_WINDOWS = 50_000

#: What parts words, once A-Z are lower-cased: all of ASCII but digits and a-z.
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def normal_words(text: Column) -> Column:
    """The words of a text, one space between them; empty if it has none."""
    return F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NOT_A_WORD, " "))


def item_windows(items: DataFrame) -> DataFrame:
    """``(item_id, words)``: the distinct windows of the items."""
    words = F.split(F.col("norm"), " ")
    n = F.size("ws")
    starts = F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1)))
    return (
        items.select("item_id", normal_words(F.col("text")).alias("norm")).where("norm <> ''")
        .select("item_id", words.alias("ws"))
        .select("item_id", "ws", F.explode(starts).alias("s"))
        .select("item_id", F.expr(f"slice(ws, s, {WINDOW})").alias("words")).distinct()
    )


def prefixes(windows: DataFrame, corpus: DataFrame) -> DataFrame:
    """``(window, words, word, at)``: of each distinct window, its rarest word
    (then the least, then the first) and that word's place in it."""
    distinct = windows.groupBy("words").agg(F.min("item_id").alias("_")).select(
        F.sha2(F.concat_ws(" ", "words"), 256).alias("window"), "words")
    placed = distinct.select("window", "words", F.posexplode("words").alias("at", "word"))
    listed = placed.select("word").distinct()
    said = corpus.select(F.explode_outer(F.split("norm", " ")).alias("word"))
    counts = keep_listed(said, listed, ["word"]).groupBy("word").count()
    least = F.min(F.struct("count", "word", "at")).alias("p")
    return (
        placed.join(counts, "word", "left").groupBy("window", "words")
        .agg(least, F.bool_and(F.col("count").isNotNull()).alias("all_there")).where("all_there")
        .select("window", "words", "p.word", "p.at")
    )


def find(corpus: DataFrame, found: DataFrame) -> DataFrame:
    """``(doc, start, length, window)``: where windows occur."""
    words = corpus.select("doc", F.split("norm", " ").alias("ws"))
    spoken = words.select("doc", "ws", F.posexplode_outer("ws").alias("i", "word"))
    start, length = F.col("i") - F.col("at"), F.size("words")
    fits = (start >= 0) & (start + length <= F.size("ws"))
    same = F.expr("slice(ws, i - at + 1, size(words)) = words")
    # the bounds come first: slice takes no start below 1
    return spoken.join(F.broadcast(found), "word").where(F.when(fits, same).otherwise(False)).select(
        "doc", start.alias("start"), length.alias("length"), "window")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc, doc_id, n_words, n_hit, item_ids)`` of every row of ``docs``; ``item_ids``
    are the items that occur in it, as sorted strings."""
    corpus = materialize(
        docs.select(F.monotonically_increasing_id().alias("doc"), "doc_id", normal_words(F.col("text")).alias("norm"))
        .withColumn("n_words", F.when(F.col("norm") == "", 0).otherwise(
            F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1).cast("long")), "words")
    windows = materialize(item_windows(items), "windows")
    found = materialize(prefixes(windows, corpus), "prefixes")
    blocks = max(1, -(-found.count() // BLOCK_WINDOWS))
    of_block = F.pmod(F.xxhash64("window"), F.lit(blocks))
    places = materialize(reduce(DataFrame.unionAll, [find(corpus, found.where(of_block == b)) for b in range(blocks)]), "places")

    end = F.col("start") + F.col("length")
    earlier = Window.partitionBy("doc").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    covered = places.select("doc", "start", "length").distinct().withColumn("_before", F.max(end).over(earlier))
    new = F.greatest(end - F.greatest("start", F.coalesce("_before", F.lit(0))), F.lit(0))
    hits = covered.groupBy("doc").agg(F.sum(new).cast("long").alias("n_hit"))

    owners = windows.where("item_id is not null").select(
        F.sha2(F.concat_ws(" ", "words"), 256).alias("window"), "item_id")
    listed = places.select("doc", "window").distinct().join(owners, "window").select("doc", "item_id").distinct()
    named = listed.groupBy("doc").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids"))
    return (
        corpus.select("doc", "doc_id", "n_words").join(hits, "doc", "left").join(named, "doc", "left")
        .select("doc", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    )


def contaminated() -> Column:
    """At least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
