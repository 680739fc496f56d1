"""Operator 13 against plain Python over documents, and its query against SQL."""

import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest

from edge_rows import EDGE_ROWS, prose

from postclust.llm import filter_audit
from postclust.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def fails_of(rows):
    """Letters of the filters that each row fails."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, _ in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        tests = {"A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": re.search(r"[#$%&*|]", t) is not None, "E": i is not None and i > first[t]}
        yield {k for k, v in tests.items() if v}


def audited(rows, good, toxic):
    """Each order applied to the documents, one after another."""
    docs = [(part or "", fails, i in good, i in toxic) for (i, _, part), fails in zip(rows, fails_of(rows))]
    removed = Counter()
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            kept = own
            for step, f in enumerate(order, 1):
                gone = [d for d in kept if f in d[1]]
                kept = [d for d in kept if f not in d[1]]
                removed[part, f] += len(gone)
                out[part, order, step] = (
                    len(kept), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in gone), sum(d[3] for d in gone))
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def told(frame):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in frame.collect()}


def test_lists_and_sets():
    rng = np.random.default_rng(3)
    for n, m in ((0, 0), (0, 5), (7, 0), (1, 1), (40, 3), (300, 200), (1000, 10)):
        a, b = (np.unique(rng.integers(0, 500, k)) for k in (n, m))
        assert filter_audit.difference(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
        c = np.unique(rng.integers(400, 900, m))
        assert filter_audit.merge([a, b, c]).tolist() == sorted({*a.tolist(), *b.tolist(), *c.tolist()})
        for least in (-1, 0, 250, 499, 1000):
            assert filter_audit.gallop(a, 0, least) == int((a < least).sum())
    assert filter_audit.merge([]).tolist() == []


ROWS = [*EDGE_ROWS, (20, "SHOUT " * 150, "en"), (21, "50 % off " + " ".join(f"w{i}" for i in range(200)), "en"),
        (22, " ".join(f"w{i}" for i in range(100)), "en"), (23, " ".join(f"w{i}" for i in range(100)), "fr"), (24, prose(150, 77), ""),
        (25, " ".join(f"w{i}" for i in range(80)) + " w1" * 20, "en"), (26, "AB" + "x" * 18, "de"), (27, "ABC" + "x" * 17, "de")]


@pytest.mark.parametrize("size", [filter_audit.RANGE, 2])
def test_against_documents(spark, monkeypatch, size):
    monkeypatch.setattr(filter_audit, "RANGE", size)  # one range a part and file, and many
    docs = spark.createDataFrame([(i, t, p, 7) for i, t, p in ROWS], "doc_id long, text string, lang string, key int").repartition(3)
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (7, None, 1), (20, 0, 1), (21, 1, None), (25, 1, 0), (None, 1, 1), (99, 1, 1), (8, 0, 0)]
    got = told(filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    good, toxic = ({i for i, *says in labels if says[k] == 1 and i is not None} for k in (0, 1))
    assert got == audited(ROWS, good, toxic)


def test_empty(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(no_docs, labels).count() == 0
    assert told(filter_audit.audit(edge_docs, labels)) == audited(EDGE_ROWS, set(), set())


def test_query(spark):
    got = QUERIES["op13_filter_interaction_audit"](spark, SMALL)
    with duckdb.connect() as c:
        for t in ("documents", "labels"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
        want = c.sql(ORACLE["op13_filter_interaction_audit"])
        assert got.columns == want.columns
        rows = want.fetchall()
        assert len(rows) == 600 * 4 and sorted(map(tuple, got.collect())) == sorted(rows)
