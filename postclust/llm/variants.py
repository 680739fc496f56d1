"""Operator 12, spelling variant grouping by a trie of letter-group counts.

1. Words are counted over all texts. Letters are put into ``GROUPS``; a word's vector is its
   number of letters of each group. One edit adds a letter (surplus 1 in one group), takes
   one (deficit 1), or replaces one (at most one of each).
2. The trie has the words arranged by the counts of group after group. Its upper ``top``
   levels are dealt out: each path of counts there is a shard. ``top`` is the least number of
   levels at which no shard has over ``SHARD_WORDS`` words (at most all levels). A word goes as
   a member to its own shard and as a query to those shards that its budget of one surplus
   and one deficit reaches; of two shards that reach each other one is asked, so each pair
   of words meets once. The queries of a shard are spread over tasks of ``QUERIES_A_TASK``.
3. In a shard all queries go down the rest of the trie depth first and together: at a node,
   each child takes those that can still pay for the difference of counts. Where few words are
   left, or no level, the words that the budget reaches are verified: exactly one code point
   inserted, deleted or replaced.
4. A task gives each word's number of near words and its best one; these are put together, and
   forms are followed to their roots by doubling (n at least doubles from form to form, so a
   chain is short).

Edge cases: a null text has no words; a run of any length is one word; copies and rows
without ``doc_id`` count like any other (a null id is written as an empty string); words are
compared by code points; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postclust.llm.common import materialize, salted_lookup

MIN_LENGTH = 5
MIN_COUNT = 3
TYPO_EVERY = 97

RUN_GAP = r"[^A-Za-zÀ-ÿ]+"

#: Letters by level of the trie, frequent ones alone; the other letters share the last.
GROUPS = ("e", "n", "t", "a", "i", "o", "rq", "hy", "ux", "szv", "clp", "dgkbj", "fmw")
LEVELS = len(GROUPS) + 1

SHARD_WORDS = 20_000
QUERIES_A_TASK = 200_000
#: A node with so many words or fewer is a leaf.
LEAF_WORDS = 32
#: Pairs verified at a time, and how long a word may be for that; longer ones one by one.
PAIRS_AT_ONCE = 500_000
MATRIX_LENGTH = 32

FOUND = "word string, n_near long, best_n long, best_word string"


def with_typos(doc_id: Column, run: Column) -> Column:
    """The run, or where ``TYPO_EVERY`` divides the CRC-32 of ``<doc_id>:<run>`` the run
    without one code point."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % TYPO_EVERY == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of the words of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences."""
    runs = docs.select(F.col("doc_id").alias("id"), F.explode(F.split("text", RUN_GAP)).alias("run")).where(F.length("run") >= MIN_LENGTH)
    capital = F.col("run").rlike("[A-Z]")
    low = F.when(capital, F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("run"))
    words = runs.select("id", low.alias("run")).select(with_typos(F.col("id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def count_vector(word: Column) -> Column:
    """Letters of each group, and of none."""
    counts = [F.length(word) - F.length(F.translate(word, g, "")) for g in GROUPS]
    return F.array(*counts, F.length(F.translate(word, "".join(GROUPS), "")))


def top_levels(vectors: DataFrame) -> int:
    """The least number of levels at which no path has over ``SHARD_WORDS`` words."""
    paths = vectors.select(F.explode(F.sequence(F.lit(1), F.lit(LEVELS))).alias("top"), "vector")
    sizes = paths.groupBy("top", F.slice("vector", F.lit(1), F.col("top")).alias("path")).count()
    largest = dict(sizes.groupBy("top").agg(F.max("count")).collect())  # a row a level
    return next((top for top in range(1, LEVELS) if largest.get(top, 0) <= SHARD_WORDS), LEVELS)


def steps_to_shards(top: int) -> list[tuple[list[int], int, int]]:
    """``(difference, surplus left, deficit left)`` of the shards a word asks: the first count that
    differs is larger there."""
    out = [([0] * top, 1, 1)]
    for up, down in product(range(top), [None, *range(top)]):
        if down is None or down > up:
            out.append(([(i == up) - (i == down) for i in range(top)], 0, 1 if down is None else 0))
    return out


def dealt(vectors: DataFrame, top: int) -> DataFrame:
    """Members (``asks`` null) and queries of each shard, queries with what is left of their budget."""
    path = F.slice("vector", 1, top)
    members = vectors.select(path.alias("shard"), "word", "n", F.lit(None).cast("int").alias("asks"), F.lit(0).alias("surplus"), F.lit(0).alias("deficit"))
    steps = ", ".join(f"struct(array({', '.join(map(str, d))}) AS d, {s} AS surplus, {t} AS deficit)" for d, s, t in steps_to_shards(top))
    asking = vectors.select(path.alias("path"), "word", "n", F.expr(f"inline(array({steps}))"))
    # asks: 1 if the path differs already, so that lesser counts may follow too
    queries = asking.select(F.zip_with("path", "d", lambda a, b: a + b).alias("shard"), "word", "n",
                            F.exists("d", lambda x: x != 0).cast("int").alias("asks"), "surplus", "deficit")
    # at most one in QUERIES_A_TASK of the queries names such a shard
    hot = queries.groupBy("shard").count().where(F.col("count") > QUERIES_A_TASK).select(
        "shard", F.ceil(F.col("count") / QUERIES_A_TASK).cast("int").alias("tasks"))
    spread = members.unionByName(queries).join(F.broadcast(hot), "shard", "left").withColumn("tasks", F.coalesce("tasks", F.lit(1)))
    salts = F.when(F.col("asks").isNull(), F.sequence(F.lit(0), F.col("tasks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("word"), F.col("tasks")).cast("int")))
    return spread.withColumn("salt", F.explode(salts)).drop("tasks")


_LEVEL_OF = np.full(256, len(GROUPS))
for _level, _letters in enumerate(GROUPS):
    _LEVEL_OF[[ord(c) for c in _letters]] = _level


class Words:
    """Words in Latin-1 with their vectors, and as rows of one matrix."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        own = np.repeat(np.arange(len(words)), self.lengths)
        self.vectors = np.bincount(own * LEVELS + _LEVEL_OF[flat], minlength=len(words) * LEVELS).reshape(-1, LEVELS).astype(np.int32)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.forward = np.zeros((len(words), MATRIX_LENGTH), dtype=np.uint8)
        self.backward = np.zeros_like(self.forward)
        fits = np.repeat(self.lengths <= MATRIX_LENGTH, self.lengths)
        self.forward[own[fits], at[fits]] = flat[fits]
        self.backward[own[fits], (np.repeat(self.lengths, self.lengths) - 1 - at)[fits]] = flat[fits]


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter makes the one the other."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def verified(q: Words, i: np.ndarray, m: Words, j: np.ndarray) -> np.ndarray:
    """Which pairs (query ``i``, member ``j``) are one edit apart."""
    near = np.zeros(len(i), dtype=bool)
    short, long = np.minimum(q.lengths[i], m.lengths[j]), np.maximum(q.lengths[i], m.lengths[j])
    fits = np.flatnonzero((long <= MATRIX_LENGTH) & (long - short <= 1))
    # letters alike from the front and from the back: all but one of the longer word together
    front = q.forward[i[fits]] != m.forward[j[fits]]
    back = q.backward[i[fits]] != m.backward[j[fits]]
    differ = front.any(axis=1)
    alike = np.argmax(front, axis=1) + np.argmax(back, axis=1)
    near[fits] = differ & (alike >= long[fits] - 1)
    for k in np.flatnonzero(long > MATRIX_LENGTH):
        near[k] = one_edit(q.words[i[k]], m.words[j[k]])
    return near


def search(members: Words, queries: Words, asks: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, top: int):
    """Depth-first search of the trie for all queries together; yields arrays of pairs
    (query, member) that the budget reaches. ``asks`` as in ``dealt``."""
    order = np.lexsort(members.vectors.T[::-1])
    counts = members.vectors[order]
    if not len(order):
        return
    # a node: its level, its words, the queries there, whether their path differs, what is left of their budget
    stack = [(top, 0, len(order), np.arange(len(asks)), asks.astype(bool), surplus, deficit)]
    while stack:
        level, low, high, q, differs, more, less = stack.pop()
        if level == LEVELS or high - low <= LEAF_WORDS:
            for block in range(0, len(q), max(1, PAIRS_AT_ONCE // (high - low))):
                part = slice(block, block + max(1, PAIRS_AT_ONCE // (high - low)))
                d = counts[None, low:high, level:] - queries.vectors[q[part], None, level:]
                up = np.maximum(d, 0).sum(axis=2)
                ok = (up <= more[part, None]) & (up - d.sum(axis=2) <= less[part, None])
                # a path that has not differed yet differs upwards first, or the words are of one vector
                first = np.take_along_axis(d, np.argmax(d != 0, axis=2)[..., None], axis=2)[..., 0] if level < LEVELS else 0 * up
                i, j = np.nonzero(ok & (differs[part, None] | (first >= 0)))
                yield q[part][i], order[low + j], differs[part][i] | (first[i, j] > 0)
            continue
        column = counts[low:high, level]
        ends = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), high - low]
        own = queries.vectors[q, level]
        for begin, end in zip(ends, ends[1:]):
            d = column[begin] - own
            can = np.flatnonzero((d <= more) & (-d <= less) & (differs | (d >= 0)))
            if len(can):
                step = d[can]
                stack.append((level + 1, low + begin, low + end, q[can], differs[can] | (step != 0),
                              more[can] - np.maximum(step, 0), less[can] - np.maximum(-step, 0)))


def near_in_shard(rows: pd.DataFrame, top: int) -> pd.DataFrame:
    """``FOUND`` of the words of a shard and those that ask it."""
    is_member = rows["asks"].isna().to_numpy()
    own, asking = rows[is_member], rows[~is_member]
    members, queries = (Words([w.encode("latin-1") for w in part["word"]]) for part in (own, asking))
    # places in one list of words, queries first; ranks by n (largest first), then by word
    words = np.concatenate([asking["word"].to_numpy(), own["word"].to_numpy()])
    ns = np.concatenate([asking["n"].to_numpy(), own["n"].to_numpy()])
    order = np.lexsort((words, -ns))
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = np.arange(len(words))
    best, n_near = np.full(len(words), len(words)), np.zeros(len(words), dtype=np.int64)

    def settle(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        i, j, differs = (np.concatenate(x) for x in zip(*held))
        # two words of one vector find each other twice: once is enough
        once = differs | (words[i] < words[len(asking) + j])
        i, j = i[once], j[once]
        near = verified(queries, i, members, j)
        i, j = i[near], j[near] + len(asking)
        np.minimum.at(best, i, rank[j])
        np.minimum.at(best, j, rank[i])
        n_near[:] += np.bincount(i, minlength=len(words)) + np.bincount(j, minlength=len(words))

    held, size = [], 0
    for found in search(members, queries, *(asking[c].to_numpy(dtype=np.int32) for c in ("asks", "surplus", "deficit")), top):
        held.append(found)
        size += len(found[0])
        if size >= PAIRS_AT_ONCE:
            settle(held)
            held, size = [], 0
    if held:
        settle(held)
    met = np.flatnonzero(n_near)
    other = order[best[met]]
    return pd.DataFrame({"word": words[met], "n_near": n_near[met], "best_n": ns[other], "best_word": words[other]})


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` of the words of a table (word, n), written once, that have a near
    word: how many, and the one of largest n (the first in code-point order of several)."""
    vectors = words.select("word", "n", count_vector(F.col("word")).alias("vector"))
    top = top_levels(vectors)

    def near(key, rows: pd.DataFrame) -> pd.DataFrame:
        return near_in_shard(rows, top)

    found = dealt(vectors, top).groupBy("shard", "salt").applyInPandas(near, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("minus_n"), F.col("best_word").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of a table (word, form): the last form of each chain."""
    table = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = table.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = salted_lookup(table, "root", further, ["word"])
        if not followed.where("next is not null").head(1):
            return table
        table = materialize(followed.select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of each word of the vocabulary of ``docs``."""
    words = materialize(vocabulary(docs), "vocabulary")
    near = near_words(words)
    better = -F.col("best.minus_n") >= 2 * F.col("n")
    judged = materialize(words.join(near, "word", "left").select(
        "word", F.when(better, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, -F.col("best.minus_n")).alias("form_n")), "judged")
    followed = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(followed, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
