"""Operator 1, token counts: rank-synchronous merging over ragged arrays.

Distinct pre-tokens of a batch lie end to end in one array of symbols. In each
round every sequence's lowest-rank adjacent pair is found at once and all its
occurrences are merged (from the left where they overlap); a sequence without a
ranked pair is done, and its symbols are counted. Rounds go on until none is left.

Edge cases: a null or empty text has 0 bytes and 0 tokens; a special string
inside a text is one token and parts the text around it; a text of any length
is counted whole; every input row gives one output row, copies and rows with a
null ``doc_id`` included; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postclust.llm.bpe import Memory, chunk_lists, default_tokenizer_path, text_batches

TOKEN_LIMIT = 1024

#: Symbols merged at a time, so that a batch's arrays stay within some MB.
SYMBOLS_AT_ONCE = 400_000

NO_RANK = np.iinfo(np.int32).max


def byte_alphabet() -> dict[int, str]:
    """Printable stand-in for each byte value in a byte-level vocabulary: bytes
    that print stand for themselves, the others for 256, 257, ... in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class RankMerger:
    """Token counts from a byte-level BPE file (vocabulary and ranked merges)."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.symbol = np.array([vocab[c] for _, c in sorted(byte_alphabet().items())], dtype=np.int64)
        self.width = max(vocab.values()) + 1
        left, right = (np.array([vocab[m[i]] for m in merges], dtype=np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        key = left * self.width + right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int32), made[order]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.split_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.memory = Memory()

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``NO_RANK`` if it has none) and the symbol it makes."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], NO_RANK), self.made[at]

    def merge_counts(self, pieces: list[bytes]) -> np.ndarray:
        """Symbols left in each of ``pieces`` (none empty) when no pair has a rank."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        counts = np.zeros(len(pieces), dtype=np.int64)
        sym = self.symbol[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        seq = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        # rank of the pair that starts at each symbol, and what it makes
        rank = np.full(len(sym), NO_RANK, dtype=np.int32)
        made = np.zeros(len(sym), dtype=np.int64)
        stale = np.arange(len(sym) - 1)
        while len(sym):
            stale = stale[seq[stale] == seq[stale + 1]]
            rank[stale], made[stale] = self.pair_ranks(sym[stale], sym[stale + 1])
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            sizes = np.diff(np.r_[starts, len(seq)])
            least = np.minimum.reduceat(rank, starts)
            done = least == NO_RANK
            counts[seq[starts[done]]] = sizes[done]
            low = np.repeat(least, sizes)
            at = np.flatnonzero((rank == low) & (low != NO_RANK))
            # of pairs that overlap (a symbol with itself) every other one, from the left
            if len(at) > 1 and (np.diff(at) == 1).any():
                run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
                within = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
                at = at[within % 2 == 0]
            sym[at] = made[at]
            keep = np.repeat(~done, sizes)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            changed = place[at]
            sym, seq, rank, made = sym[keep], seq[keep], rank[keep], made[keep]
            # pairs that hold a merged symbol are looked up again
            rank[changed] = NO_RANK
            before = changed[changed > 0] - 1
            before = before[seq[before] == seq[before + 1]]
            rank[before] = NO_RANK
            again = np.zeros(len(sym), dtype=bool)
            again[before] = again[changed] = True
            stale = np.flatnonzero(again[:-1])
        return counts

    def _learn(self, chunks: list[str]) -> dict[str, int]:
        """Counts of chunks."""
        pieces = [[p.encode() for p in self.pattern.findall(c)] for c in chunks]
        counted: dict[bytes, int] = {}
        part: list[bytes] = []
        size = 0
        for p in {p for ps in pieces for p in ps}:
            part.append(p)
            size += len(p)
            if size >= SYMBOLS_AT_ONCE:
                counted.update(zip(part, self.merge_counts(part).tolist()))
                part, size = [], 0
        if part:
            counted.update(zip(part, self.merge_counts(part).tolist()))
        return {c: sum([counted[p] for p in ps]) for c, ps in zip(chunks, pieces)}

    def count_batch(self, texts: list[str | None]) -> list[int]:
        """Token counts of whole texts; the chunks new to the batch are merged together."""
        spans: list[tuple[int, str]] = []  # (text, part between special strings)
        counts = [0] * len(texts)
        for i, text in enumerate(texts):
            if text and self.split_special and any(s in text for s in self.special):
                between = self.split_special.split(text)
                counts[i] += len(between) - 1
                spans += [(i, s) for s in between if s]
            elif text:
                spans.append((i, text))
        parts, distinct = chunk_lists([s for _, s in spans])
        get = self.memory.of(distinct, lambda new: dict(zip(new, self._learn([" " + c for c in new]).values()))).__getitem__
        heads = self._learn(list({p[0] for p in parts if p[0]})) | {"": 0}
        for (i, _), p in zip(spans, parts):
            counts[i] += heads[p[0]] + sum(map(get, islice(p, 1, None)))
        return counts


_mergers: dict[str, RankMerger] = {}


def merger(path: str) -> RankMerger:
    """The worker process's merger, kept from task to task."""
    if path not in _mergers:
        _mergers[path] = RankMerger(path)
    return _mergers[path]


def token_counter(tokenizer_path: str):
    """Column function: tokens of a text column."""

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = merger(tokenizer_path)
        for texts in batches:
            rows = texts.tolist()
            yield pd.Series([n for s in text_batches(rows) for n in counter.count_batch(rows[s])], dtype="int64")

    return n_tokens


def token_counts(docs: DataFrame, tokenizer_path: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row of ``docs``."""
    count = token_counter(tokenizer_path or default_tokenizer_path())
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        count("text").alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
