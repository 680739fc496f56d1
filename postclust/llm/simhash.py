"""Operator 4, SimHash near-dedup by multi-index hashing.

A document's fingerprint has a bit where over half of its word shingles' 64-bit
hashes have it. Fingerprints are cut into ``SEGMENTS`` segments. Two that differ
in at most ``max_bits`` bits agree, in at least one segment, up to the segment's
radius (the first ``max_bits % SEGMENTS + 1`` segments: ``max_bits // SEGMENTS``;
the others one less). So the table holds every distinct fingerprint by the value
of each segment, a fingerprint asks for all values in the small Hamming ball
round each of its own, and the complete distance of what it finds is verified.

Copies collapse before the join: it works on distinct fingerprints. Those within
2 of 64 bits of one are at most 2,080 in number, so links grow with the
distinct fingerprints, however large a group of copies is.

Edge cases: a null or empty text, or one of white space, has fingerprint zero
and is linked like any other; fewer words than a shingle are one shingle;
shingles that repeat count each time; rows without ``doc_id`` are grouped, but
name no component unless all its rows lack one (then it is null); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postclust.llm.common import materialize, salted_lookup
from postclust.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 2
SEED = 42

#: Shingle hashes whose bits are counted at a time.
HASHES_AT_ONCE = 100_000


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """XXH64 of all k-word shingles; A-Z in lower case, words parted by ASCII white space."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())]
    return np.array(hashes, dtype=np.uint64)


def fingerprints_of(texts: list[str | None], k: int) -> np.ndarray:
    """Fingerprint of each text, as a signed 64-bit number."""
    out = np.zeros(len(texts), dtype=np.uint64)
    for i, text in enumerate(texts):
        hashes = shingle_hashes(text or "", k)
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), HASHES_AT_ONCE):
            part = hashes[at:at + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]
    return out.astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` of every row, ``fp`` a signed 64-bit number."""

    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(fingerprints_of(texts.tolist(), shingle_words))

    return docs.select("doc_id", fingerprint("text").alias("fp"))


def segments(max_bits: int) -> list[tuple[int, int, int]]:
    """``(lowest bit, width, radius)`` of each segment; a negative radius is left out."""
    width = 64 // SEGMENTS
    low, more = divmod(max_bits, SEGMENTS)
    radii = [low if i <= more else low - 1 for i in range(SEGMENTS)]
    return [(i * width, width, r) for i, r in enumerate(radii) if r >= 0]


def ball(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def segment_value(fp: str, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints within ``max_bits`` bits."""
    held, asked = [], []
    for i, (low, width, radius) in enumerate(segments(max_bits)):
        value = segment_value("fp", low, width)
        held.append(F.struct(F.lit(i).alias("s"), value.alias("v")))
        asked += [F.struct(F.lit(i).alias("s"), value.bitwiseXOR(F.lit(m).cast("long")).alias("v")) for m in ball(width, radius)]
    table = distinct.select(F.col("fp").alias("b"), F.inline(F.array(*held)))
    asks = distinct.select(F.col("fp").alias("a"), F.inline(F.array(*asked)))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return asks.join(table, ["s", "v"]).where(near).select("a", "b").distinct()


def near_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row; the component is named by
    the least ``doc_id`` that links reach, the document itself included."""
    rows = materialize(fingerprints(docs, shingle_words), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = connected_components(near_links(classes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = materialize(classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = salted_lookup(rooted, "root", named, ["fp"]).select("fp", "component_id")
    return salted_lookup(rows, "fp", by_class, ["doc_id"]).select("doc_id", "fp", "component_id")
