"""Operator 12 against plain Python over all pairs of words, and its query against SQL."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from edge_rows import EDGE_ROWS

from postclust.llm import variants
from postclust.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def edits(w, letters):
    """All strings one edit away."""
    cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    out = {a + b[1:] for a, b in cut if b} | {a + c + b[k:] for a, b in cut for c in letters for k in (0, 1) if len(b) >= k}
    return out - {w}


def counted(rows):
    n = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def grouped(n):
    letters = {c for w in n for c in w}
    near = {w: [v for v in edits(w, letters) if v in n] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v if n[v] >= 2 * n[w] else None for w, v in best.items()}

    def root(w):
        while form.get(w):
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), k, len(near[w]), n[form[w]] if form.get(w) else None) for w, k in n.items()), key=repr)


def test_one_edit_and_verified_pairs():
    rng = random.Random(2)
    words = [b"abcab", b"abcabc", b"bcab", b"aacab", b"abcba", b"x" * 40, b"x" * 39, b"x" * 20 + b"y" + b"x" * 20, b"a", b""]
    words += ["".join(rng.choice("abé") for _ in range(rng.randrange(1, 7))).encode("latin-1") for _ in range(150)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    want = [words[b].decode("latin-1") in edits(words[a].decode("latin-1"), "abcxyé") for a, b in zip(i, j)]
    assert [variants.one_edit(words[a], words[b]) for a, b in zip(i, j)] == want
    held = variants.Words(words)
    assert variants.verified(held, i, held, j).tolist() == want


@pytest.mark.parametrize("leaf", [1, 32])
def test_search_finds_each_pair_once(monkeypatch, leaf):
    monkeypatch.setattr(variants, "LEAF_WORDS", leaf)
    rng = random.Random(leaf)
    words = sorted({"".join(rng.choice("aeintüz") for _ in range(rng.randrange(5, 8))) for _ in range(900)} | {"a" * 40, "a" * 41})
    rows = pd.DataFrame({"word": words, "n": 3})
    shard = pd.concat([rows.assign(asks=np.nan, surplus=0, deficit=0), rows.assign(asks=0, surplus=1, deficit=1)])
    got = variants.near_in_shard(shard, 0).groupby("word")["n_near"].sum()
    known = set(words)
    want = {w: len(edits(w, "aeintüz") & known) for w in words}
    assert got.to_dict() == {w: n for w, n in want.items() if n}


@pytest.mark.parametrize("sizes", [(20_000, 200_000), (5, 7), (0, 3)])
def test_near_words_over_shards(spark, monkeypatch, sizes):
    """One level and one task a shard; several; all levels, hot shards over many tasks."""
    monkeypatch.setattr(variants, "SHARD_WORDS", sizes[0])
    monkeypatch.setattr(variants, "QUERIES_A_TASK", sizes[1])
    rng = random.Random(3)
    n = {"".join(rng.choice("abei") for _ in range(rng.randrange(5, 7))): rng.randrange(3, 40) for _ in range(150)}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best.word, -r.best.minus_n) for r in variants.near_words(words).collect()}
    want = {}
    for w in n:
        if vs := [v for v in edits(w, "abei") if v in n]:
            first = min(vs, key=lambda v: (-n[v], v))
            want[w] = (len(vs), first, n[first])
    assert got == want


def test_documents(spark, edge_docs, no_docs):
    texts = [(i, "Schönes schones SCHONES schöne schnes École ecole ×÷×÷× abcde-abcde_abcde " * 4, "en") for i in range(300)]
    rows = [*texts, (None, "abcdx abcdx\tabcdx schoneses " * 3, "en"), (5, "y" * 60 + " " + "y" * 60, None), (5, "y" * 60, None), (6, "y" * 61 + " " + "z" * 100_000, None)]
    docs = spark.createDataFrame([(i, t, w, 7) for i, t, w in rows], "doc_id long, text string, word string, n int")
    got = sorted(map(tuple, variants.spelling_variants(docs).collect()), key=repr)
    assert got == grouped(counted(rows))
    got = sorted(map(tuple, variants.spelling_variants(edge_docs).collect()), key=repr)
    assert got == grouped(counted(EDGE_ROWS))
    assert variants.spelling_variants(no_docs).count() == 0


def test_long_chain(spark):
    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(60)], "word string, form string")
    assert {r.root for r in variants.roots(forms).collect()} == {"w060"}
    assert variants.roots(forms.where(F.lit(False))).count() == 0


def test_query(spark):
    got = QUERIES["op12_spelling_variants"](spark, SMALL)
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
        want = c.sql(ORACLE["op12_spelling_variants"])
        assert got.columns == want.columns
        found = sorted(map(tuple, got.collect()), key=repr)
        assert found == sorted(want.fetchall(), key=repr)
        assert found == grouped(counted(c.sql("SELECT doc_id, text FROM documents").fetchall()))
