"""Operator 11 against brute force: the index by itself, the operator, and its query."""

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
from pyspark.sql import functions as F

from edge_rows import EDGE_ROWS

from postclust.llm import cuckoo
from postclust.llm.cuckoo import CuckooIndex
from postclust.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def digests(numbers):
    return cuckoo.as_digests(b"".join(hashlib.sha256(str(i).encode()).digest() for i in numbers))


def columns(numbers):
    n = np.array(list(numbers), dtype=np.int64)
    return digests(n.tolist()), n, n, np.ones(len(n), dtype=np.int64)


def test_index_inserts_finds_and_resizes():
    index = CuckooIndex(2)
    index.insert(*columns(range(5000)))
    assert index.buckets * cuckoo.SLOTS >= 5000 and index.buckets > 2  # overflow made it grow
    place = index.find(digests(range(6000)))
    assert (place[:5000] >= 0).all() and (place[5000:] == -1).all()
    assert (index.digests[place[:5000]] == digests(range(5000))).all()
    assert sorted(place[:5000]) == list(range(5000))
    assert (index.fingerprints > 0).sum() == 5000


def test_a_hit_is_verified_against_the_whole_digest():
    index = CuckooIndex(64)
    one = digests([1])
    index.insert(one, *(np.array([i]) for i in (1, 1, 1)))
    other = one.copy()
    other[0, 3] ^= 1  # same fingerprint, same buckets
    assert index.find(one)[0] == 0 and index.find(other)[0] == -1
    index.insert(other, *(np.array([i]) for i in (9, 9, 1)))
    assert index.ns.tolist() == [1, 1] and index.find(other)[0] == 1


def test_index_against_a_dictionary():
    rng = random.Random(5)
    index, live = CuckooIndex(), {}
    for _ in range(60):
        numbers = [rng.randrange(400) for _ in range(rng.randrange(1, 200))]
        if rng.random() < 0.3:
            assert index.delete(digests(numbers)) == len(set(numbers) & live.keys())
            for i in numbers:
                live.pop(i, None)
        else:
            ids = [rng.choice([int(cuckoo.NO_ID), rng.randrange(50)]) for _ in numbers]
            keys = [rng.randrange(10**9) for _ in numbers]
            index.insert(digests(numbers), np.array(ids), np.array(keys), np.ones(len(ids), dtype=np.int64))
            for i, d, k in zip(numbers, ids, keys):
                was = live.get(i, (d, k, 0))
                live[i] = (*max((d, k), was[:2]), was[2] + 1)
        place = index.find(digests(range(400)))
        assert {i for i in range(400) if place[i] >= 0} == set(live)
        assert {i: (index.ids[p], index.keys[p], index.ns[p]) for i, p in enumerate(place) if p >= 0} == live
        assert (index.fingerprints > 0).sum() == len(live)
        again = CuckooIndex.of_row(index.row(0, 1))
        assert (again.find(digests(range(400))) == place).all()


def check(marked, rows):
    """Marked rows against groups of equal texts."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    got = defaultdict(list)
    for r in marked.select("*", F.lower(F.hex("digest")).alias("sha")).collect():
        got[r.sha].append(r)
    assert got.keys() == groups.keys()
    for sha, ids in groups.items():
        most = max((i for i in ids if i is not None), default=None)
        assert sorted((r.doc_id for r in got[sha]), key=repr) == sorted(ids, key=repr)
        assert {(r.keep_id, r.group_size) for r in got[sha]} == {(most, len(ids))}
        stays = [r.doc_id for r in got[sha] if r.kept]
        assert stays == [most]  # one, also of rows alike in doc_id


def test_marks_and_drops(spark, edge_docs, no_docs, monkeypatch):
    rows = [(i, t) for i, t, _ in EDGE_ROWS]
    for shard_rows in (cuckoo.SHARD_ROWS, 3):  # one shard, and many
        monkeypatch.setattr(cuckoo, "SHARD_ROWS", shard_rows)
        check(cuckoo.mark_copies(edge_docs), rows)
    left = cuckoo.drop_copies(edge_docs)
    assert left.columns == edge_docs.columns
    texts = [r.text or "" for r in left.select("text").collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t in rows})
    assert cuckoo.mark_copies(no_docs).count() == 0 and cuckoo.drop_copies(no_docs).count() == 0


def test_hot_text(spark, monkeypatch):
    monkeypatch.setattr(cuckoo, "FOLD_ROWS", 50)
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    marked = cuckoo.mark_copies(docs)
    assert marked.where("kept").count() == 601
    assert marked.where("group_size = 300 and keep_id = 897").count() == 300


def test_stored_index_takes_more_and_loses_some(spark):
    def table(ids):
        docs = spark.createDataFrame([(i, f"text {i % 40}") for i in ids], "doc_id long, text string")
        return cuckoo.digests_of(docs, F.col("doc_id"))

    index = cuckoo.build_index(table(range(30)), shards=5)
    index = cuckoo.insert_digests(index, table(range(30, 60)))
    live = {r.keep_id: r.group_size for r in cuckoo.live_digests(index).collect()}
    assert live == {i: 2 if i >= 40 else 1 for i in range(20, 60)}
    index = cuckoo.delete_digests(index, table(range(40, 50)))
    assert {r.keep_id for r in cuckoo.live_digests(index).collect()} == {*range(20, 40), *range(50, 60)}
    index = cuckoo.insert_digests(index, table([3, 100]))  # a deleted text is new, a live one is a copy
    live = {r.keep_id: r.group_size for r in cuckoo.live_digests(index).collect()}
    assert live[3] == 1 and live[100] == 2 and len(live) == 31


def test_query(spark):
    got = QUERIES["op11_exact_dedup"](spark, SMALL)
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
        want = c.sql(ORACLE["op11_exact_dedup"])
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
