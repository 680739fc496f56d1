"""Operator 5, token-id output as wavelet matrices.

Documents are dealt out by ranges of ``doc_id``; each range is one shard, one
compressed Parquet file. Its rows are blocks of whole documents of about
``BLOCK_TOKENS`` ids, each a wavelet matrix: one bit-plane per bit of an id, the
ids of a plane ordered stably by the bits above it, with the ones before every
512th bit counted. From the files follow the id at a place (``token_at``, by access), how
often an id occurs before a place (``count_token``, by rank) and where it occurs
(``find_token``, by select).

Edge cases: a null or empty text has the end id alone; documents without
``doc_id`` come first, ties and copies side by side by a hash of their text; a
document longer than a block is a block of its own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postclust.llm.bpe import array_batches, default_tokenizer_path, encoder, release_memory
from postclust.llm.common import may_broadcast, scratch_path

END_ID = 2

#: Ids after which a block is closed.
BLOCK_TOKENS = 1 << 20

#: Bits between two counts of the ones before.
RANK_BITS = 512

SHARD_SCHEMA = (
    "shard int, block int, first long, n_tokens long, width int, doc_ids array<long>, lengths array<long>, "
    "zeros array<long>, planes binary, ranks binary"
)
TOKENS_SCHEMA = "shard int, doc_id long, start_in_shard long, ids binary"


class WaveletMatrix:
    """A sequence of ids as bit-planes, the highest bit first."""

    def __init__(self, n: int, width: int, zeros: list[int], planes: bytes, ranks: bytes):
        self.n, self.width, self.zeros = n, width, zeros
        self.planes = np.frombuffer(planes, dtype=np.uint8).reshape(width, -1) if n else np.zeros((width, 0), np.uint8)
        self.ranks = np.frombuffer(ranks, dtype="<u4").reshape(width, -1) if n else np.zeros((width, 1), "<u4")

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        kind = np.uint16 if width <= 16 else np.uint32
        cur = ids.astype(kind)
        zeros, planes, ranks = [], [], []
        for level in range(width):
            bit = (cur >> kind(width - 1 - level)) & kind(1) != 0
            plane = np.packbits(bit)
            words = np.zeros(-(-len(plane) * 8 // RANK_BITS) * (RANK_BITS // 8), dtype=np.uint8)
            words[:len(plane)] = plane
            ones = np.bitwise_count(words.view("<u8")).reshape(-1, RANK_BITS // 64).sum(axis=1, dtype=np.uint32)
            planes.append(plane)
            ranks.append(np.r_[np.uint32(0), np.cumsum(ones, dtype=np.uint32)[:-1]].astype("<u4") if len(ones) else ones.astype("<u4"))
            low = np.compress(~bit, cur)
            zeros.append(len(low))
            cur = np.concatenate((low, np.compress(bit, cur)))
        return cls(len(ids), width, zeros, b"".join(p.tobytes() for p in planes), b"".join(r.tobytes() for r in ranks))

    def ids(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        cur = np.zeros(self.n, dtype=kind)
        for level in reversed(range(self.width)):
            bit = np.unpackbits(self.planes[level], count=self.n).view(bool)
            out = np.empty_like(cur)
            z = self.zeros[level]
            out[np.flatnonzero(~bit)] = cur[:z]
            out[np.flatnonzero(bit)] = cur[z:] | kind(1 << (self.width - 1 - level))
            cur = out
        return cur.astype("<u4")

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i >> 3] >> (7 - (i & 7))) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if i == 0:
            return 0
        k = (i - 1) // RANK_BITS
        begin = k * RANK_BITS // 8
        whole, rest = divmod(i - k * RANK_BITS, 8)
        n = int(self.ranks[level, k]) + int(np.bitwise_count(self.planes[level, begin:begin + whole]).sum())
        return n + (int(self.planes[level, begin + whole]) >> (8 - rest)).bit_count() if rest else n

    def _down(self, level: int, i: int, bit: int) -> int:
        ones = self._ones(level, i)
        return self.zeros[level] + ones if bit else i - ones

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for level in range(self.width):
            bit = self._bit(level, i)
            value = value << 1 | bit
            i = self._down(level, i, bit)
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        a, b = 0, i
        for level in range(self.width):
            bit = token >> (self.width - 1 - level) & 1
            a, b = self._down(level, a, bit), self._down(level, b, bit)
        return a, b

    def rank(self, token: int, i: int | None = None) -> int:
        """How often an id occurs in the first ``i`` places (all if None)."""
        if token >> self.width:
            return 0
        a, b = self._range(token, self.n if i is None else i)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The place of the ``k``-th (from 0) occurrence of an id."""
        if not 0 <= k < self.rank(token):
            raise IndexError(k)
        at = self._range(token, self.n)[0] + k
        for level in reversed(range(self.width)):
            bit = token >> (self.width - 1 - level) & 1
            at = self._find(level, at - self.zeros[level] if bit else at, bit)
        return at

    def _find(self, level: int, k: int, bit: int) -> int:
        """The place of a plane's ``k``-th (from 0) one or zero."""
        low, high = 0, self.n  # the least i of whose first i bits more than k are such
        while low < high:
            mid = (low + high) // 2
            ones = self._ones(level, mid)
            low, high = (low, mid) if (ones if bit else mid - ones) > k else (mid + 1, high)
        return low - 1

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.rank(token))]


def _block(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["n_tokens"], row["width"], row["zeros"], row["planes"], row["ranks"])


def write_shards(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID,
                 block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode ``docs`` in ascending ``doc_id`` order into shards under ``path``."""
    tokenizer_path = tokenizer_path or default_tokenizer_path()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        width = max(coder.tokenizer.get_vocab_size() - 1, end_id).bit_length()
        end = np.array([end_id], dtype="<u4").tobytes()
        schema = pa.schema([
            ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32()),
            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("zeros", pa.list_(pa.int64())),
            ("planes", pa.binary()), ("ranks", pa.binary())])
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        keys, parts, size = [], [], 0

        def closed() -> pa.RecordBatch:
            m = WaveletMatrix.build(np.frombuffer(b"".join(parts), dtype="<u4"), width)
            row = [shard, block, first, m.n, width, keys, [len(p) // 4 for p in parts], m.zeros, m.planes.tobytes(), m.ranks.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for part in array_batches(texts):
                ids, n = coder.encode_array(texts[part])
                for key, coded in zip(doc_ids[part], np.split(ids, np.cumsum(n)[:-1])):
                    keys.append(key)
                    parts.append(coded.astype("<u4").tobytes() + end)
                    size += len(parts[-1]) // 4
                    if size >= block_tokens:
                        yield closed()
                        block, first = block + 1, first + size
                        keys, parts, size = [], [], 0
        if parts:
            yield closed()
        release_memory()

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(blocks, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def decode(shards: DataFrame) -> DataFrame:
    """``(shard, doc_id, start_in_shard, ids)`` of every document, the ids little-endian unsigned 32-bit."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = _block(row).ids()
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([row["shard"]] * len(ends), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start_in_shard": pa.array(starts + row["first"], pa.int64()),
                    "ids": pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                })

    return shards.mapInArrow(documents, TOKENS_SCHEMA)


def with_starts(shards: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (of :func:`decode`) with ``start``, the ids of all documents before.
    The totals are summed over one row per shard."""
    totals = shards.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    if may_broadcast(totals):
        before = F.broadcast(before)
    return rows.join(before, "shard").withColumn("start", F.col("before") + F.col("start_in_shard")).drop("before")


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """``(shard, doc_id, place)``: where an id occurs, ``place`` counted from its document's start."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                at = np.array(_block(row).occurrences(token), dtype=np.int64)
                ends = np.cumsum(row["lengths"])
                doc = np.searchsorted(ends, at, side="right")
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([row["shard"]] * len(at), pa.int32()),
                    "doc_id": pa.array([row["doc_ids"][d] for d in doc], pa.int64()),
                    "place": pa.array(at - (ends - row["lengths"])[doc], pa.int64()),
                })

    return shards.mapInArrow(places, "shard int, doc_id long, place long")


def count_token(shards: DataFrame, token: int, upto: int | None = None) -> int:
    """How often an id occurs before place ``upto`` of the whole output (everywhere if None): ranks
    of the blocks before it, read from their bit-planes. A block gives one number."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [_block(row).rank(token, max(0, min(row["n_tokens"], row["upto"] - row["start"]))) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n"])

    placed = _placed(shards).withColumn("upto", F.lit(upto).cast("long") if upto is not None else F.col("start") + F.col("n_tokens"))
    return placed.where("start < upto").mapInArrow(counted, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def token_at(shards: DataFrame, places: list[int]) -> dict[int, int]:
    """The ids at some places of the whole output (a place beyond it is left out). Only the blocks
    that hold them are opened, and each gives its few ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(p, block.access(p - row["start"])) for row in batch.to_pylist() for block in [_block(row)]
                     for p in places if row["start"] <= p < row["start"] + row["n_tokens"]]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["place", "id"])

    wanted = F.array(*[F.lit(p).cast("long") for p in places])
    held = F.exists(wanted, lambda p: (p >= F.col("start")) & (p < F.col("start") + F.col("n_tokens")))
    return dict(_placed(shards).where(held).mapInArrow(read, "place long, id long").collect()) if places else {}


def _placed(shards: DataFrame) -> DataFrame:
    """Blocks with ``start``, the ids of all blocks before in the whole output."""
    return with_starts(shards, shards.withColumn("start_in_shard", F.col("first")))


def round_trip(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the shards to the shared folder and read them back: ``(doc_id, start, ids)``."""
    path = scratch_path(docs.sparkSession, "shards")
    write_shards(docs, path, tokenizer_path, end_id)
    shards = read_shards(docs.sparkSession, path)
    return with_starts(shards, decode(shards)).select("doc_id", "start", "ids")
