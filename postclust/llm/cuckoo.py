"""Operator 11, exact dedup by a cuckoo-filter index of live digests.

A document's digest is the SHA-256 of its text (a null text is an empty one). The
index is a table in the shared folder with one row a shard; a digest's first bits name
its shard. A shard holds

* a cuckoo filter: buckets of ``SLOTS`` 16-bit fingerprints. A fingerprint stands in one
  of two buckets, either of which follows from the other and the fingerprint;
* the content of the buckets: beside each fingerprint the place of its digest in the
  shard's store of digest, row that stays, and number of rows.

A digest is looked up by its fingerprint in its two buckets; each hit is verified
against the whole digest that the slot refers to. An equal one is a copy: the row that
stays is the later of the two and the rows add up. Else the digest goes in, moving
fingerprints between their two buckets until each has a slot. If some find none in
``MAX_MOVES`` rounds, or too few are free, the filter overflows: it is made anew, twice as large, from the
stored digests. Deleted digests leave their slots, and a copy that comes later is new.

Rows are folded by digest in the task that reads them, before they go to their shards, so
a text that a third of all rows share is a row or so from each task. A shard's size is
bounded by the number of shards, which follows from the number of rows.

Of equal texts the row with the largest ``doc_id`` stays (null is below all others);
of rows alike in that too, one stays. Edge cases: null and empty texts are equal;
a text of any length is one digest; an empty table gives an empty result and an index
without shards; other columns are ignored by ``mark_copies`` and kept by ``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postclust.llm.common import counted_join, keep_listed, materialize, row_keyed

SLOTS = 4
#: Rounds of moves after which a filter counts as full.
MAX_MOVES = 64
#: Share of the slots that may be taken.
MAX_LOAD = 0.95
#: Buckets of a new filter.
FIRST_BUCKETS = 64
#: Rows a shard should get.
SHARD_ROWS = 200_000
#: Rows that a reading task folds together.
FOLD_ROWS = 200_000

NO_ID = np.iinfo(np.int64).min  # a null doc_id, below all others

FOLDED = "shard int, digest binary, id long, key long, n long"
SHARD = "shard int, shards int, buckets int, fingerprints binary, refs binary, digests binary, ids binary, keys binary, ns binary"


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class CuckooIndex:
    """The filter and the content of one shard; all operations take whole arrays."""

    def __init__(self, buckets: int = FIRST_BUCKETS):
        self.digests = np.zeros((0, 4), dtype="<u8")  # 32 bytes each
        self.ids, self.keys, self.ns = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.fingerprints = np.zeros((buckets, SLOTS), dtype=np.uint16)  # 0: a free slot
        self.refs = np.zeros((buckets, SLOTS), dtype=np.int32)

    @property
    def buckets(self) -> int:
        return len(self.fingerprints)

    def _print(self, digests: np.ndarray) -> np.ndarray:
        return (digests[:, 1] % np.uint64(65535)).astype(np.uint16) + np.uint16(1)

    def _home(self, digests: np.ndarray) -> np.ndarray:
        return (digests[:, 2] & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The other bucket of a fingerprint (its own inverse)."""
        spread = prints.astype(np.uint64) * np.uint64(0x5BD1E995) >> np.uint64(7)
        return bucket ^ (spread & np.uint64(self.buckets - 1)).astype(np.int64)

    def _slots(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and slot of each digest (-1: it is not there)."""
        prints, home = self._print(digests), self._home(digests)
        at, slot = np.full(len(digests), -1), np.full(len(digests), -1)
        for bucket in (home, self._other(home, prints)):
            for s in range(SLOTS):
                hit = np.flatnonzero((self.fingerprints[bucket, s] == prints) & (at < 0))
                # verify against the content: the whole digest
                hit = hit[(self.digests[self.refs[bucket[hit], s]] == digests[hit]).all(axis=1)]
                at[hit], slot[hit] = bucket[hit], s
        return at, slot

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Place of each digest in the store (-1: not live)."""
        at, slot = self._slots(digests)
        return np.where(at >= 0, self.refs[at, slot], -1)

    def _place(self, refs: np.ndarray) -> bool:
        """Give each of the stored digests ``refs`` a slot; False if the filter overflows."""
        if len(self.digests) > MAX_LOAD * SLOTS * self.buckets:
            return False
        prints = self._print(self.digests[refs])
        bucket = self._home(self.digests[refs])
        refs = refs.astype(np.int32)
        for move in range(MAX_MOVES):
            for _ in range(2):  # a free slot in the one bucket, then in the other
                for s in range(SLOTS):
                    free = np.flatnonzero(self.fingerprints[bucket, s] == 0)
                    _, first = np.unique(bucket[free], return_index=True)  # one a bucket
                    took = free[first]
                    self.fingerprints[bucket[took], s], self.refs[bucket[took], s] = prints[took], refs[took]
                    rest = np.ones(len(refs), dtype=bool)
                    rest[took] = False
                    prints, bucket, refs = prints[rest], bucket[rest], refs[rest]
                bucket = self._other(bucket, prints)
                if not len(refs):
                    return True
            # both buckets are full: take the place of a fingerprint, which moves to its other bucket
            _, mover = np.unique(bucket, return_index=True)
            b, s = bucket[mover], (refs[mover] + move) % SLOTS
            prints[mover], self.fingerprints[b, s] = self.fingerprints[b, s], prints[mover].copy()
            refs[mover], self.refs[b, s] = self.refs[b, s], refs[mover].copy()
            bucket[mover] = self._other(b, prints[mover])
        return False

    def _resize(self) -> None:
        """Make the filter anew from the stored digests, larger until all have a slot."""
        buckets = self.buckets
        while True:
            buckets *= 2
            self._clear(buckets)
            if self._place(np.arange(len(self.digests))):
                return

    def insert(self, digests: np.ndarray, ids: np.ndarray, keys: np.ndarray, ns: np.ndarray) -> None:
        """Rows ``keys`` with ``ids``, each for ``ns`` rows of its digest."""
        if not len(digests):
            return
        # the rows of one digest in the batch fold first
        order = np.lexsort((keys, ids, *digests.T))
        digests, ids, keys, ns = digests[order], ids[order], keys[order], ns[order]
        last = np.r_[(digests[1:] != digests[:-1]).any(axis=1), True]
        ends = np.flatnonzero(last)
        ns = np.add.reduceat(ns, np.r_[0, ends[:-1] + 1])
        digests, ids, keys = digests[ends], ids[ends], keys[ends]

        place = self.find(digests)
        copy = np.flatnonzero(place >= 0)
        live = place[copy]
        self.ns[live] += ns[copy]
        later = copy[(ids[copy] > self.ids[live]) | ((ids[copy] == self.ids[live]) & (keys[copy] > self.keys[live]))]
        self.ids[place[later]], self.keys[place[later]] = ids[later], keys[later]

        new = np.flatnonzero(place < 0)
        if len(new):
            refs = np.arange(len(self.digests), len(self.digests) + len(new))
            self.digests = np.concatenate([self.digests, digests[new]])
            self.ids, self.keys = np.r_[self.ids, ids[new]], np.r_[self.keys, keys[new]]
            self.ns = np.r_[self.ns, ns[new]]
            if not self._place(refs):
                self._resize()

    def delete(self, digests: np.ndarray) -> int:
        """Take digests out of the index; how many were live."""
        at, slot = self._slots(np.unique(digests, axis=0))
        at, slot = at[at >= 0], slot[at >= 0]
        gone = self.refs[at, slot]
        self.fingerprints[at, slot] = 0
        # the store closes up, and the slots refer to the new places
        left = np.ones(len(self.digests), dtype=bool)
        left[gone] = False
        moved = np.cumsum(left) - 1
        self.digests, self.ids, self.keys, self.ns = self.digests[left], self.ids[left], self.keys[left], self.ns[left]
        full = self.fingerprints > 0
        self.refs[full] = moved[self.refs[full]]
        return len(gone)

    def row(self, shard: int, shards: int) -> dict:
        parts = {"fingerprints": self.fingerprints, "refs": self.refs, "digests": self.digests, "ids": self.ids,
                 "keys": self.keys, "ns": self.ns}
        return {"shard": shard, "shards": shards, "buckets": self.buckets} | {k: np.ascontiguousarray(v).tobytes() for k, v in parts.items()}

    @classmethod
    def of_row(cls, row) -> CuckooIndex:
        index = cls(int(row["buckets"]))
        index.fingerprints = np.frombuffer(row["fingerprints"], dtype=np.uint16).reshape(-1, SLOTS).copy()
        index.refs = np.frombuffer(row["refs"], dtype=np.int32).reshape(-1, SLOTS).copy()
        index.digests = as_digests(row["digests"])
        index.ids, index.keys, index.ns = (np.frombuffer(row[k], dtype=np.int64).copy() for k in ("ids", "keys", "ns"))
        return index


def as_digests(joined: bytes) -> np.ndarray:
    return np.frombuffer(joined, dtype="<u8").reshape(-1, 4).copy()


def digest_list(digests: np.ndarray) -> list[bytes]:
    raw = digests.tobytes()
    return [raw[i:i + 32] for i in range(0, len(raw), 32)]


def shard_of(digests: np.ndarray, shards: int) -> np.ndarray:
    return (digests[:, 0] % np.uint64(shards)).astype(np.int32)


def fold(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (digest, id, key) folded by digest within each reading task, with their shard."""

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            ids = t["id"].fill_null(int(NO_ID)).to_numpy()
            index = CuckooIndex()
            index.insert(as_digests(b"".join(t["digest"].to_pylist())), ids, t["key"].to_numpy(), np.ones(len(t), dtype=np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(shard_of(index.digests, shards)), pa.array(digest_list(index.digests), pa.binary()),
                 pa.array(index.ids), pa.array(index.keys), pa.array(index.ns)],
                names=["shard", "digest", "id", "key", "n"])

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= FOLD_ROWS:
                yield flush()
                held.clear()
                size = 0
        if size:
            yield flush()

    return rows.select("digest", "id", "key").mapInArrow(folded, FOLDED)


def _insert(index: CuckooIndex, rows: pd.DataFrame) -> CuckooIndex:
    index.insert(as_digests(b"".join(rows["digest"])), *(rows[c].to_numpy(dtype=np.int64) for c in ("id", "key", "n")))
    return index


def build_index(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """The index (rows of ``SHARD``) of a table of (digest, id, key), written once. A key
    is a row's number; it tells apart rows alike in digest and id."""
    n = shards or max(1, -(-rows.count() // SHARD_ROWS))

    def build(key, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_insert(CuckooIndex(), part).row(key[0], n)])

    return materialize(fold(rows, n).groupBy("shard").applyInPandas(build, SHARD), "cuckoo")


def _changed(index: DataFrame, rows: DataFrame, change) -> DataFrame:
    """The index after ``change(a shard's index, its rows)``, as a new table."""
    n = index.agg(F.max("shards")).first()[0] or 1

    def changed(key, shard: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        found = CuckooIndex.of_row(shard.iloc[0]) if len(shard) else CuckooIndex()
        if len(part):
            change(found, part)
        return pd.DataFrame([found.row(key[0], n)])

    return materialize(index.groupBy("shard").cogroup(fold(rows, n).groupBy("shard")).applyInPandas(changed, SHARD), "cuckoo")


def insert_digests(index: DataFrame, rows: DataFrame) -> DataFrame:
    """The index with the rows of a further table of (digest, id, key)."""
    return _changed(index, rows, _insert)


def delete_digests(index: DataFrame, digests: DataFrame) -> DataFrame:
    """The index without the digests of a table: their texts are no longer live."""
    keyed = digests.select("digest", F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("key"))
    return _changed(index, keyed, lambda found, part: found.delete(as_digests(b"".join(part["digest"]))))


def live_digests(index: DataFrame) -> DataFrame:
    """``(digest, keep_id, keep_key, group_size)`` of each live digest, read from the index."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                found = CuckooIndex.of_row(row)
                place = found.find(found.digests)  # each is reached through the filter
                yield pd.DataFrame({
                    "digest": digest_list(found.digests),
                    "keep_id": pd.array(found.ids[place], dtype="Int64").copy(),
                    "keep_key": found.keys[place], "group_size": found.ns[place],
                }).assign(keep_id=lambda f: f["keep_id"].mask(f["keep_id"] == NO_ID))

    return index.mapInPandas(listed, "digest binary, keep_id long, keep_key long, group_size long")


def digests_of(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """``(key, id, digest)`` of each row, written once; the key is the row's own number."""
    key = F.monotonically_increasing_id() if key is None else key
    return materialize(docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("id"), digest_of(F.col("text")).alias("digest")), "digests")


def mark_copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, digest, key)`` of each row of ``docs``."""
    return _marked(digests_of(docs))


def _marked(rows: DataFrame) -> DataFrame:
    live = materialize(live_digests(build_index(rows)).withColumn("n", F.col("group_size")), "live")
    joined = counted_join(rows, ["digest"], live, "n")
    return joined.select(F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("key") == F.col("keep_key")).alias("kept"),
                         "digest", "key")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = row_keyed(docs)
    marked = _marked(digests_of(rows.select("row.doc_id", "row.text", "key"), F.col("key")))
    stay = materialize(marked.where("kept").select("key"), "stay")
    return keep_listed(rows, stay, ["key"]).select("row.*")
