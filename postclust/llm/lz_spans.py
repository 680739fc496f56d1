"""Operator 9, substring dedup by relative Lempel-Ziv parsing.

The reference is the corpus itself, cut into segments that its own words decide. Of
the ``GRAM``-word grams in a window of ``WINDOW`` words the one with the least hash
is the window's anchor, so equal windows have equal anchors. The windows in a row
that share an anchor form one segment: the words from the first to the last of them.
All different segments with one anchor are a reference block. A document therefore
shares a window only with the blocks of its own anchors, and meets no others:

1. A segment whose anchor no other document has is new text.
2. A segment that an earlier document has whole is copied whole.
3. Other segments are parsed against their block, each different one once for all
   documents that repeat it. The block holds the segments of earlier documents, indexed
   by their suffixes in order. From left to right, each factor is the longest run of
   words that stands in the block, and the next one begins where it ends (after a word
   that the block lacks, if it is empty). Windows within a factor are duplicates. A window
   across a boundary can be one only if the factor that begins there reaches its end,
   so these, and no others, are looked up as a whole.

The words that duplicate windows cover are duplicate spans. Every window is in exactly one
segment, so none is missed. Blocks of more than ``BLOCK_SEGMENTS`` segments (an anchor in
very many contexts) are not parsed: their windows are joined by 128 bits of hash.

Grouping is by anchors and contents with counts first; keys that hold over a
thousandth of the rows are broadcast (``counted_join``), the others shuffled. Segments
and words are known by hashes.

Edge cases: a null or empty text has no words and keeps none; fewer words than a
window have no duplicates; documents without ``doc_id`` come after all others and
not before each other; rows that share a ``doc_id`` are never duplicates of each
other and are told apart by 128 bits of their text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postclust.llm.common import counted_join, materialize, may_broadcast, salted_lookup

WINDOW = 50
GRAM = 8

#: Different segments of an anchor that are indexed together.
BLOCK_SEGMENTS = 256

#: Bytes that stand for a word in an index.
WORD = 8

LAST_ID = (1 << 63) - 1

# Odd multipliers of the rolling hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)
OTHER_BASE = np.uint64(0xC2B2AE3D27D4EB4F)

BLOCK_SCHEMA = "id long, text_hash struct<high:long,low:long>, anchor long, content long, start int, windows int"


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


class Rolling:
    """Hashes of any run of words: of words x to y, the sum of the word's hash times
    the base to the power of its place in the run."""

    def __init__(self, hashes: np.ndarray, base: np.uint64):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        n = len(hashes)
        self.back = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse)], dtype=np.uint64)
        ahead = np.cumprod(np.r_[np.uint64(1), np.full(n, base)], dtype=np.uint64)
        self.sums = np.r_[np.uint64(0), np.cumsum(hashes * ahead[:-1], dtype=np.uint64)]

    def runs(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.back[begin]


def blocks_of(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(anchor, content, start, windows)`` of a text's reference blocks."""
    n = len(words)
    if n < window:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    rolling = Rolling(word_hashes(words), BASE)
    at = np.arange(n - gram + 1)
    grams = mixed(rolling.runs(at, at + gram))
    choices = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    anchor = at[:n - window + 1] + choices.argmin(axis=1)
    start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    windows = np.diff(np.r_[start, len(anchor)])
    place = anchor[start]
    content = rolling.runs(start, start + windows + window - 1)
    content = mixed(content + mixed((windows * window + (place - start)).astype(np.uint64)))
    return grams[place], content, start, windows


def window_hashes(words: list[bytes], start: list[int], windows: list[int], window: int) -> tuple[np.ndarray, ...]:
    """Two hashes of each window of the given blocks, block after block."""
    hashes = word_hashes(words)
    at = np.concatenate([np.arange(s, s + m) for s, m in zip(start, windows)])
    return tuple(mixed(Rolling(hashes, b).runs(at, at + window)) for b in (BASE, OTHER_BASE))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), text_digest().alias("text_hash"), "doc_id", "text")


def text_digest() -> Column:
    """128 bits of the text: rows alike in ``id`` and in this are one document."""
    digest = F.md5(F.coalesce("text", F.lit("")))
    return F.struct(*[F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(name) for at, name in ((1, "high"), (17, "low"))])


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def reference_blocks(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("id").to_numpy(), batch.column("text_hash")
            found = [blocks_of(split_words(t), window, gram) for t in batch.column("text").to_pylist()]
            if not found:
                continue
            sizes = [len(f[0]) for f in found]
            anchor, content, start, windows = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(np.repeat(ids, sizes)), "text_hash": hashes.take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
                "anchor": signed(anchor), "content": signed(content),
                "start": pa.array(start.astype(np.int32)), "windows": pa.array(windows.astype(np.int32))})

    return rows.select("id", "text_hash", "text").mapInArrow(cut, BLOCK_SCHEMA)


class ReferenceBlock:
    """Segments, as words of ``WORD`` bytes end to end, indexed by their suffixes in order."""

    def __init__(self):
        self.suffixes: list[bytes] = []

    def add(self, segment: bytes) -> None:
        for i in range(0, len(segment), WORD):
            insort(self.suffixes, segment[i:])

    def longest(self, words: bytes) -> int:
        """How many of the first words stand in a segment in a row."""
        at = bisect_left(self.suffixes, words)
        return max((common_words(words, s) for s in self.suffixes[max(0, at - 1):at + 1]), default=0)

    def holds(self, words: bytes) -> bool:
        at = bisect_left(self.suffixes, words)
        return at < len(self.suffixes) and self.suffixes[at].startswith(words)

    def factors(self, segment: bytes) -> list[tuple[int, int]]:
        """Greedy parse: ``(first word, words)`` of each factor; one of no words stands for a new word."""
        out, i = [], 0
        while i * WORD < len(segment):
            out.append((i, self.longest(segment[i * WORD:])))
            i += max(1, out[-1][1])
        return out

    def duplicates(self, segment: bytes, window: int) -> int:
        """The windows (bits, by first word) of a segment that stand in the block."""
        mask = 0
        factors = self.factors(segment)
        for first, n in factors:
            if n >= window:
                mask |= ((1 << (n - window + 1)) - 1) << first
        for (first, n), (b, m) in zip(factors, factors[1:]):
            # windows that begin in the one factor and end in the next
            for p in range(max(first, b - window + 1), min(b, b + m - window + 1) if n else first):
                if self.holds(segment[p * WORD:(p + window) * WORD]):
                    mask |= 1 << p
        return mask


def common_words(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b)) // WORD
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low * WORD:mid * WORD] == b[low * WORD:mid * WORD] else (low, mid - 1)
    return low


def parse_block(segments: list[tuple[int, int, bytes]], window: int) -> list[tuple[int, int]]:
    """``(content, mask)`` of those of a block's segments (id, content, words) that have windows
    which a segment of a lesser id has."""
    block, out = ReferenceBlock(), []
    for _, same in groupby(sorted(segments, key=lambda x: x[0]), key=lambda x: x[0]):
        same = list(same)
        out += [(content, mask) for _, content, words in same if (mask := block.duplicates(words, window))]
        for _, _, words in same:
            block.add(words)
    return out


def parsed_segments(rows: DataFrame, segments: DataFrame, window: int) -> DataFrame:
    """``(anchor, content, mask)`` of the given segments, by parsing each against its block."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_in() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("anchor", "id", "content", "words")))

        out = []
        for anchor, own in groupby(rows_in(), key=lambda r: r[0]):
            out += [(anchor, content, mask) for content, mask in parse_block([r[1:] for r in own], window)]
            if len(out) >= 10_000:
                yield masked(out)
                out = []
        if out:
            yield masked(out)

    def masked(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["anchor", "content", "mask"])

    dealt = segment_words(rows, segments, window).repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(parse, "anchor long, content long, mask long")


def of_segments(rows: DataFrame, segments: DataFrame, made, schema: str) -> DataFrame:
    """What ``made(id, words of the text, its segments)`` returns (arrays by name) for all
    documents that have some of the given segments."""
    lists = segments.groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "windows", "anchor", "content"))).alias("blocks"))
    joined = listed_rows(rows, lists).select("id", "text", "blocks")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id_, text, own in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "blocks"))):
                yield pa.RecordBatch.from_pydict(made(id_, split_words(text), own))

    return joined.mapInArrow(each, schema)


def segment_words(rows: DataFrame, segments: DataFrame, window: int) -> DataFrame:
    """``(anchor, content, id, words)``: the given segments with their words, ``WORD`` bytes each."""

    def made(id_: int, words: list[bytes], own: list[dict]) -> dict:
        raw = word_hashes(words).tobytes()
        return {"anchor": pa.array([b["anchor"] for b in own], pa.int64()), "content": pa.array([b["content"] for b in own], pa.int64()),
                "id": pa.array([id_] * len(own), pa.int64()),
                "words": pa.array([raw[b["start"] * WORD:(b["start"] + b["windows"] + window - 1) * WORD] for b in own], pa.binary())}

    return of_segments(rows, segments, made, "anchor long, content long, id long, words binary")


def segment_windows(rows: DataFrame, segments: DataFrame, window: int) -> DataFrame:
    """``(anchor, content, nth, id, w, v)``: the windows of the given segments, by two hashes."""

    def made(id_: int, words: list[bytes], own: list[dict]) -> dict:
        windows = [b["windows"] for b in own]
        w, v = window_hashes(words, [b["start"] for b in own], windows, window)
        return {
            "anchor": pa.array(np.repeat([b["anchor"] for b in own], windows)),
            "content": pa.array(np.repeat([b["content"] for b in own], windows)),
            "nth": pa.array(np.concatenate([np.arange(m) for m in windows]).astype(np.int32)),
            "id": pa.array(np.full(len(w), id_, dtype=np.int64)), "w": signed(w), "v": signed(v)}

    return of_segments(rows, segments, made, "anchor long, content long, nth int, id long, w long, v long")


def joined_segments(rows: DataFrame, segments: DataFrame, window: int) -> DataFrame:
    """As ``parsed_segments``, by a join of windows: for blocks too large to index."""
    singles = materialize(segment_windows(rows, segments, window), "windows")
    key = F.struct("w", "v").alias("key")
    earliest = singles.groupBy(key).agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    found = salted_lookup(singles.select(key, "id", "anchor", "content", "nth"), "key", earliest.select("key", "least"),
                          ["anchor", "content"], how="inner").where("id > least")
    return found.groupBy("anchor", "content").agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("mask"))


def listed_rows(rows: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """Join documents to their lists. The keys are counted: up to ``BROADCAST_BYTES``
    they are broadcast first, so that only the texts asked for are shuffled."""
    keys = lists.select("id", "text_hash")
    if may_broadcast(keys):
        rows = rows.join(F.broadcast(keys), ["id", "text_hash"], "left_semi")
    return rows.join(lists, ["id", "text_hash"], how)


def duplicate_windows(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(id, text_hash, spans)``: of documents with windows that an earlier one has, the
    blocks (start, mask of their windows that are such)."""
    blocks = materialize(reference_blocks(rows, window, gram), "blocks")
    anchors = blocks.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n"))
    shared = materialize(anchors.where("a < b").select("anchor", "n"), "anchors")
    met = materialize(counted_join(blocks, ["anchor"], shared, "n", "left_semi"), "met")

    contents = materialize(met.groupBy("anchor", "content").agg(
        F.min(F.struct("id", "text_hash", "start", "windows")).alias("first"), F.count("*").alias("n")), "contents")
    several = materialize(contents.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1"), "several")
    segments = contents.select("anchor", "content", "first.*")
    small = counted_join(segments, ["anchor"], several.where(F.col("k") <= BLOCK_SEGMENTS), "k", "left_semi")
    large = counted_join(segments, ["anchor"], several.where(F.col("k") > BLOCK_SEGMENTS), "k", "left_semi")
    masks = parsed_segments(rows, small, window).unionByName(joined_segments(rows, large, window))

    known = materialize(contents.join(masks, ["anchor", "content"], "left").select(
        "anchor", "content", F.col("first.id").alias("first_id"), F.coalesce("mask", F.lit(0)).cast("long").alias("mask"), "n"), "known")
    copied = counted_join(met, ["anchor", "content"], known, "n")
    mask = F.when(F.col("id") > F.col("first_id"), F.expr("shiftleft(1L, windows) - 1")).otherwise(F.col("mask"))
    copied = copied.withColumn("mask", mask).where("mask <> 0")
    return copied.groupBy("id", "text_hash").agg(F.collect_set(F.struct("start", "mask")).alias("spans"))


def covered(n: int, spans: list[dict], window: int) -> np.ndarray:
    """Which of ``n`` words a duplicate window covers."""
    starts = [s["start"] + i for s in spans for i in range(s["mask"].bit_length()) if s["mask"] >> i & 1]
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.array(starts, dtype=np.int64) + window, -1)
    return np.cumsum(step[:-1]) > 0


def remove_spans(rows: DataFrame, window: int) -> DataFrame:
    """``(doc_id, n_words, spans, text)``: the duplicate spans (first word, word after the
    last) and the words that are left, one space between them."""
    schema = "doc_id long, n_words long, spans array<struct<begin:int,end:int>>, text string"
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, taken, texts = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = split_words(text)
                counts.append(len(words))
                if spans:
                    out = covered(len(words), spans, window)
                    edges = np.flatnonzero(np.diff(np.r_[False, out, False].astype(np.int8))).tolist()
                    taken.append([{"begin": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                    words = [w for w, gone in zip(words, out.tolist()) if not gone]
                else:
                    taken.append([])
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(taken, span), "text": pa.array(texts, pa.string())})

    return rows.select(F.col("doc_id").cast("long"), "text", "spans").mapInArrow(cut, schema)


def dedup_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_words, spans, text)`` of every row, ``text`` without the duplicate spans."""
    rows = keyed(docs)
    lists = materialize(duplicate_windows(rows, window, gram), "spans")
    keys = lists.select("id", "text_hash")
    if may_broadcast(keys):
        keys = F.broadcast(keys)
    whole = rows.join(keys, ["id", "text_hash"], "left_anti").withColumn("spans", F.lit(None).cast("array<struct<start:int,mask:bigint>>"))
    cut = listed_rows(rows, lists)
    return remove_spans(cut.unionByName(whole), window)
