"""Operator 13, filter interaction audit over sorted posting lists.

1. Each row gets a number of its own (rising with the rows of a file) and the filters that
   it fails; this narrow table is written once.
2. A filter's failing rows of a part within a range of ``RANGE`` numbers are one sorted
   posting list; so are the part's good and toxic rows. A list has ``RANGE`` numbers at
   most, however large the part.
3. For every set of filters the union of its lists is merged by galloping: what a list
   adds is its difference to the union so far, found by searching the ends of its runs.
   The sizes of the differences and unions add up over the ranges.
4. Each order of the filters reads its steps off these sums: what a step removes is the
   difference of its list to the union of the lists before it.

Filters, on whole texts (null: empty): A, under 100 words; B, under 80 % of the words are
different; C, over 10 % of the characters are capitals A-Z; D, one of ``#$%&*|``; E, the text
of a smaller ``doc_id``, whichever part that is in.

Edge cases: a null part is the empty string; rows alike count one by one; a row without
``doc_id`` fails E never and makes no other row fail it, and has no label; a document is
good (toxic) if any of its rows in ``labels`` says so; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postclust.llm.common import counted_join, materialize, salted_lookup
from postclust.llm.cuckoo import digest_of

FILTERS = "ABCDE"
GOOD, TOXIC = "good", "toxic"
LISTS = (*FILTERS, GOOD, TOXIC)
ALL = (1 << len(FILTERS)) - 1
SPACE = r"[\x20\x09-\x0D]+"

#: Rows whose numbers a posting list may hold.
RANGE = 1 << 16

SUMS = ("removed", "good_lost", "toxic_lost")
SIZES = "part string, before int, filter int, removed long, good_lost long, toxic_lost long"
NONE = np.zeros(0, dtype=np.int64)


def failing(text: Column) -> Column:
    """The filters of A to D that a text fails, as an array of letters. It should be a column
    (and not a longer expression), as it is used several times."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    said = F.transform(F.array(words), lambda ws: F.struct(F.size(ws).alias("n"), F.size(F.array_distinct(ws)).alias("different")))[0]
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = {
        "A": lambda s: s["n"] < 100,
        "B": lambda s: 100 * s["different"].cast("long") < 80 * s["n"].cast("long"),
        "C": lambda s: 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        "D": lambda s: text.rlike(r"[#$%&*|]"),
    }
    tested = lambda s: F.array(*[F.when(test(s), F.lit(name)) for name, test in fails.items()])
    return F.array_compact(F.transform(F.array(said), tested)[0])


def rows_of(docs: DataFrame, part: Column) -> DataFrame:
    """``(key, id, part, digest, fails)`` of each row, written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("id"),
                         F.coalesce(part.cast("string"), F.lit("")).alias("part"), text.alias("said"))
    return materialize(narrow.select("key", "id", "part", digest_of(F.col("said")).alias("digest"), failing(F.col("said")).alias("fails")), "audited")


def later_copies(rows: DataFrame) -> DataFrame:
    """``(part, key)`` of the rows whose text a smaller id has too."""
    known = rows.where("id is not null")
    first = known.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
    several = materialize(first.where("first < last").drop("last"), "several")
    return counted_join(known.select("part", "key", "id", "digest"), ["digest"], several, "n").where("id > first").select("part", "key")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, what, key)`` of the good and the toxic rows."""
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias(GOOD), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias(TOXIC))
    found = salted_lookup(rows.select("part", "key", "id"), "id", said.where(F.col(GOOD) | F.col(TOXIC)), ["key"], how="inner")
    what = F.array_compact(F.array(*[F.when(F.col(c), F.lit(c)) for c in (GOOD, TOXIC)]))
    return found.select("part", F.explode(what).alias("what"), "key")


def posting_lists(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, id_range, A, ..., E, good, toxic)``: sorted lists of row numbers."""
    entries = (
        rows.select("part", F.explode("fails").alias("what"), "key")
        .unionByName(later_copies(rows).withColumn("what", F.lit("E")))
        .unionByName(labelled(rows, labels))
    )
    kept = [F.sort_array(F.collect_list(F.when(F.col("what") == c, F.col("key")))).alias(c) for c in LISTS]
    return entries.groupBy("part", F.floor(F.col("key") / RANGE).alias("id_range")).agg(*kept)


def gallop(ids: np.ndarray, low: int, least: int) -> int:
    """The first place from ``low`` on whose id is ``least`` or more: steps that double
    pass it, then the last step is halved."""
    step, high = 1, low
    while high < len(ids) and ids[high] < least:
        low, high, step = high + 1, high + step, 2 * step
    return low + int(np.searchsorted(ids[low:min(high, len(ids))], least))


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ids of ``a`` that ``b`` lacks; both sorted."""
    if not len(a) or not len(b):
        return a
    # only where the ranges of the two overlap is anything looked up
    begin, end = gallop(a, 0, b[0]), gallop(a, 0, b[-1] + 1)
    first, last = gallop(b, 0, a[0]), gallop(b, 0, a[-1] + 1)
    within, other = a[begin:end], b[first:last]
    if not len(within) or not len(other):
        return a
    at = np.searchsorted(other, within)
    held = other[np.minimum(at, len(other) - 1)] == within
    return np.concatenate([a[:begin], within[~held], a[end:]])


def merge(lists: list[np.ndarray]) -> np.ndarray:
    """Union of sorted lists: numpy's stable sort of int64 finds them as runs and merges
    these by galloping; of equal ids one stays."""
    ids = np.sort(np.concatenate([NONE, *lists]), kind="stable")
    return ids[np.r_[True, ids[1:] != ids[:-1]]] if len(ids) else ids


def set_sizes(lists: dict[str, np.ndarray]) -> list[tuple[int, int, int, int, int]]:
    """For each set of filters (bits) and each filter outside it: ``(before, filter, removed,
    good_lost, toxic_lost)`` of what the filter's list adds to the union of the set's."""
    out = []
    for before in range(ALL):
        held = merge([lists[name] for k, name in enumerate(FILTERS) if before >> k & 1])
        for k, name in enumerate(FILTERS):
            if before >> k & 1:
                continue
            new = difference(lists[name], held)
            if len(new):
                lost = [len(new) - len(difference(new, lists[c])) for c in (GOOD, TOXIC)]
                out.append((before, k, len(new), *lost))
    return out


def sizes(lists: DataFrame) -> DataFrame:
    """Sums over the ranges, ``SIZES``; what is zero throughout is left out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.string()), *[(c, pa.int32()) for c in ("before", "filter")], *[(c, pa.int64()) for c in SUMS]])
        for batch in batches:
            rows = []
            for i in range(len(batch)):
                held = {c: batch[c][i].values.to_numpy() for c in LISTS}
                rows += [(batch["part"][i].as_py(), *r) for r in set_sizes(held)]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    measured = lists.drop("id_range").mapInArrow(counted, SIZES)
    return measured.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in SUMS])


def steps() -> list[tuple[str, int, int, int]]:
    """``(filter_order, step, filter, before)`` of all orders, and of which set the step's
    filter is tested after."""
    out = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[k] for k in order), 0
        for i, k in enumerate(order, 1):
            out.append((name, i, k, before))
            before |= 1 << k
    return out


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley)``: a row for each part, order of the filters and step."""
    rows = rows_of(docs, F.col(f"`{part}`"))
    measured = materialize(sizes(posting_lists(rows, labels)), "sizes")

    # a filter comes right after the n of a set in n! * (number of filters - 1 - n)! orders
    orders = [factorial(n) * factorial(len(FILTERS) - 1 - n) for n in range(len(FILTERS))]
    weight = F.element_at(F.array(*map(F.lit, orders)), F.bit_count("before") + 1)
    of_filter = measured.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("failing"),
        F.sum(F.when(F.expr(f"before + shiftleft(1, filter) = {ALL}"), F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * weight).alias("shapley"),
    )
    plan = ", ".join(f"struct('{order}' AS filter_order, {step} AS step, {k} AS filter, {before} AS before)" for order, step, k, before in steps())
    each = rows.groupBy("part").agg(F.count("*").alias("total")).select("part", "total", F.expr(f"inline(array({plan}))"))
    joined = each.join(measured, ["part", "before", "filter"], "left").join(of_filter, ["part", "filter"], "left")
    joined = joined.fillna(0, [*SUMS, "failing", "unique_fails", "shapley"])
    gone = F.sum("removed").over(Window.partitionBy("part", "filter_order").orderBy("step"))
    return joined.select("part", "filter_order", "step", (F.col("total") - gone).alias("kept"), "removed",
                         (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")
