"""Operator 2, best-fit packing: the plan is made over a histogram of lengths.

1. Every document is encoded, ended with id 0 and cut into pieces of at most
   ``capacity`` tokens (only the first may be shorter); the pieces are written
   once to the shared folder.
2. The number of pieces of each length (at most ``capacity`` counts, whatever
   the corpus) goes to the driver, which packs counts, longest first, each into
   the fullest open sequences that still have room. Equal sequences are moved
   as one range of numbers, so the plan has a bounded number of rows: at most
   one range is split for each length and capacity left, and a sequence holds
   at most ``sqrt(2 * capacity)`` different lengths.
3. A piece's rank within its length follows from counts per (length, salt) and
   its place within those, so that no task holds all pieces of one length. It
   joins the plan's ranges on (length, salt) and takes its slot.

Edge cases: a null or empty text has one piece, the end id alone; copies and
rows that share or lack a ``doc_id`` are packed like any other; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postclust.llm.bpe import array_batches, default_tokenizer_path, encoder, release_memory
from postclust.llm.common import materialize

CAPACITY = 2048
END_ID = 0

#: Tasks over which the pieces of one length are ranked.
RANK_SALTS = 64

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids binary"
PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids"]
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
PLAN_SCHEMA = "length long, first_rank long, n long, per_sequence long, first_sequence long, first_offset long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens; only the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def encode_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, narrow: bool = False) -> DataFrame:
    """Pieces of all documents with their ids, little-endian unsigned 32-bit; ``narrow``: 16-bit
    where the vocabulary fits."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        kind = np.dtype("<u2" if narrow and max(len(coder.token_bytes) - 1, end_id) < 1 << 16 else "<u4")
        end, size = np.array([end_id], dtype=kind).tobytes(), kind.itemsize
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for part in array_batches(texts):
                ids, n = coder.encode_array(texts[part])
                raw, ends, out = ids.astype(kind).tobytes(), size * np.cumsum(n), []
                for key, a, b in zip(keys[part], [0, *ends.tolist()], ends.tolist()):
                    own = raw[a:b] + end
                    for i, (start, length) in enumerate(cut(len(own) // size, capacity)):
                        out.append((key, i, start, length, own[size * start:size * (start + length)]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), PIECE_TYPES)], names=PIECE_NAMES)
        release_memory()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECE_SCHEMA)


def widened(pieces: DataFrame) -> DataFrame:
    """``pieces`` with 32-bit ``ids``, whichever they had."""

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = batch.column("ids"), batch.schema.get_field_index("ids")
            ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1]
            data = np.frombuffer(ids.buffers()[2], np.uint8)[ends[0]:ends[-1]].tobytes() if len(ids) else b""
            if data and len(data) == 2 * pc.sum(batch.column("length")).as_py():
                wide = np.frombuffer(data, "<u2").astype("<u4").tobytes()
                offsets = (2 * (ends - ends[0])).astype(np.int32).tobytes()
                ids = pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(wide)])
            yield batch.set_column(at, batch.schema.field(at), ids)

    return pieces.mapInArrow(widen, pieces.schema)


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths: rows of ``PLAN_SCHEMA``.

    A row places ``n`` pieces of a length, from ``first_rank`` on, ``per_sequence``
    to a sequence from ``first_sequence`` on, side by side from ``first_offset``.
    """
    plan = []
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # ranges (first, number) by space left
    sequences = 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            space = next((s for s in range(length, capacity) if room[s]), capacity)
            each = space // length
            if space == capacity:
                first, number = sequences, -(-left // each)
                sequences += number
            else:
                first, number = room[space].pop()
                if number > (most := -(-left // each)):
                    room[space].append((first + most, number - most))
                    number = most
            placed = min(left, number * each)
            plan.append((length, rank, placed, each, first, capacity - space))
            full, rest = divmod(placed, each)
            if full:
                room[space - each * length].append((first, full))
            if rest:
                room[space - rest * length].append((first + full, 1))
            left, rank = left - placed, rank + placed
    return plan


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any rows with a ``length`` of 1 to ``capacity``) with
    ``sequence_id`` and ``offset``. It is read twice, so it should be a table."""
    spark = pieces.sparkSession
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(RANK_SALTS)).cast("int"))
    counts = salted.groupBy("length", "_salt").count().collect()  # at most capacity * RANK_SALTS rows
    total: dict[int, int] = {}
    before: list[tuple[int, int, int, int]] = []
    for length, salt, n in sorted(counts):
        before.append((length, salt, total.get(length, 0), n))
        total[length] = total.get(length, 0) + n
    plan = spark.createDataFrame(plan_slots(total, capacity), PLAN_SCHEMA)
    ranges = spark.createDataFrame(before, "length long, _salt int, before long, here long")
    # the plan rows that the ranks of a (length, salt) can meet, and how those ranks begin
    slots = ranges.join(plan, "length").where(
        (F.col("before") < F.col("first_rank") + F.col("n")) & (F.col("first_rank") < F.col("before") + F.col("here"))
    )
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("_nth", F.row_number().over(within) - 1)
    joined = ranked.join(slots, ["length", "_salt"]).withColumn("_rank", F.col("_nth") + F.col("before") - F.col("first_rank"))
    return joined.where((F.col("_rank") >= 0) & (F.col("_rank") < F.col("n"))).select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(F.col("_rank") / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + F.col("_rank") % F.col("per_sequence") * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         payload: dict[str, Column] | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, sequence_id, offset)`` and what is asked
    for of each piece: its ``ids`` if nothing else, or the ``payload`` columns
    made of them, which then travel in their place."""
    path = tokenizer_path or default_tokenizer_path()
    pieces = materialize(encode_pieces(docs, path, capacity, end_id, narrow=payload is None), "pieces")
    if payload is None:
        return widened(place(pieces, capacity))
    return place(pieces.select("doc_id", "piece", "start", "length", *[c.alias(name) for name, c in payload.items()]), capacity)
