"""Operators 3, 6, 7 and 10 and the pipeline against brute force and planted cases."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import line_model
from edge_rows import EDGE_ROWS, prose

import corpus_pipeline
from test_near import fingerprint, roots_of
from tokenizers import Tokenizer

from postclust.llm import decontaminate, language_id, secrets
from postclust.llm.bpe import default_tokenizer_path
from postclust.llm.line_templates import drop_recurring_lines

from postclust.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def judged(text, items):
    words, hit, found = words_of(text), set(), set()
    for item, said in items:
        own = words_of(said)
        n = min(13, len(own))
        windows = {tuple(own[s:s + n]) for s in range(max(1, len(own) - 12))} if own else set()
        for s in range(len(words) - n + 1 if n else 0):
            if tuple(words[s:s + n]) in windows:
                hit.update(range(s, s + n))
                found.add(item)
    ids = sorted(str(i) for i in found if i is not None)
    return len(words), len(hit), tuple(ids), len(hit) > 0 and 20 * len(hit) >= len(words)


def test_contamination(spark, edge_docs, no_docs, monkeypatch):
    items = [(1, prose(40, 1)), (2, "ONE"), (3, "12 34"), (4, None), (5, "--"), (6, prose(13, 9)), (10, prose(20, 5)), (10, "été"),
             (None, "straße"), (7, "words that nobody says"), (2, "ONE"), (8, "ab ab ab")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(3))
    want = Counter((i, *judged(t, items)) for i, t, _ in EDGE_ROWS)
    for block in (decontaminate.BLOCK_WINDOWS, 10):  # one pass over the corpus, and several
        monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
        rows = decontaminate.contamination(edge_docs, bench).withColumn("c", decontaminate.contaminated()).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.c) for r in rows) == want
    assert decontaminate.contamination(no_docs, bench).count() == 0
    clean = decontaminate.contamination(edge_docs, bench.where("false")).collect()
    assert len(clean) == len(EDGE_ROWS) and not any(r.n_hit for r in clean)


ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
                    r"""[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def spans_of(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return tuple(sorted(found))


SECRET_TEXTS = [
    "token = token = abcdefgh", "secret:short", "api_key='k3y-value' apikey : 123456", "AKIAAKIA" + "A1" * 8, "AKIA" + "B" * 15,
    "\U0001f600 é token=\"0123456789abcdef0123456789abcdef\"", "paſsword = abcdefgh", "Key token=aaaaaa;TOKEN='bbbbbb", "f" * 23, "f" * 24 + "g" + "0" * 30,
    "password" * 400 + "=abcdef", "Password\n=abcdef", "token==abcdef", "secret = 'AKIA" + "C" * 16 + "'",
]


def test_secrets(spark, edge_docs, no_docs):
    rows = [(i % 9 if i % 5 else None, t) for i, t in enumerate(SECRET_TEXTS)] + [(i, t) for i, t, _ in EDGE_ROWS]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rules", F.lit("x")).repartition(3)
    got = Counter((r.doc_id, tuple((s.start, s.kind_order, s.end, s.kind) for s in r.spans)) for r in secrets.scan(frame).collect())
    assert got == Counter((i, spans_of(t)) for i, t in rows)
    assert sum(len(s) for _, s in got) > 12
    assert secrets.scan(no_docs).count() == 0


def test_trigram_queries():
    asked = {r.name: secrets.trigram_query(r.pattern) for r in secrets.RULES}
    assert asked["hex"] == [] and asked["access"] == [frozenset({"aki", "kia"})]
    assert frozenset({"tok", "oke", "ken"}) in asked["assign"] and len(asked["assign"]) == 6
    assert secrets.trigram_query("ab?cd|efgh") == [frozenset({"abc", "bcd"}), frozenset({"acd"}), frozenset({"efg", "fgh"})]
    assert secrets.trigram_query("abc|d") == []  # an alternative without trigrams: scan all
    assert secrets.trigram_query("abc.def") == [frozenset({"abc", "def"})]


def test_index_holds_back_documents(spark):
    frame = spark.createDataFrame([(1, "sector toe ken"), (2, "my Token: x"), (3, "nothing")], "doc_id long, text string")
    assert {r.doc_id: set(r.rules) for r in secrets.candidates(frame).collect()} == {2: {"assign"}}


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(0)
    model = language_id.BiGru(["a", "b", "c"])
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    rows = rng.integers(97, 102, (4, language_id.STEPS)).astype(np.uint8)
    valid = (np.arange(language_id.STEPS)[:, None] < np.array([64, 64, 9, 30])).astype(np.float64)
    label = np.array([0, 1, 2, 1])
    _, g = model.gradients(rows, valid, label)
    for k, v in model.p.items():
        for _ in range(3):
            i = tuple(rng.integers(0, n) for n in v.shape)
            i = (i[0], int(rows[0, 5])) if k[0] == "x" else i
            v[i] += 1e-3
            up, _ = model.gradients(rows, valid, label)
            v[i] -= 2e-3
            down, _ = model.gradients(rows, valid, label)
            v[i] += 1e-3
            assert (up - down) / 2e-3 == pytest.approx(g[k][i], rel=1e-2, abs=1e-6)


def test_batches_do_not_change_a_document():
    model = language_id.BiGru(["a", "b"])
    texts = ["x", "é" * 100, prose(900, 1), "y" * language_id.STEPS]
    together = model.documents(texts)
    assert np.allclose(together, np.concatenate([model.documents([t]) for t in texts]), atol=1e-5)
    assert np.allclose(together.sum(axis=1), 1, atol=1e-4)


def test_language_id_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_id.identify(docs).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held)


def test_language_id_edges(edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(language_id, "ROUNDS", 5)
    rows = language_id.identify(edge_docs).collect()
    assert len(rows) == len(EDGE_ROWS)
    letters = {i: any(c.isalpha() for c in t or "") for i, t, _ in EDGE_ROWS if i is not None}
    for r in rows:
        if r.doc_id is None:
            assert r.held_out is None
        else:
            assert (r.lang_pred == "und") == (not letters[r.doc_id])
            assert r.lang_pred in ("und", "en", "fr", "de") and (r.score == 0) == (r.lang_pred == "und")
    assert language_id.identify(no_docs).count() == 0
    unlabelled = language_id.identify(edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


LINES = [
    (1, "All rights reserved here.\nfirst text of one"), (2, "second text of two\nAll rights reserved here."),
    (3, "All rights reserved here.\nthird text, of three\nAll rights reserved here."),
    (4, "user 17 logged in from 10.0.0.1"), (5, "user 230 logged in from 10.9.0.1\nown words stand here"), (6, "user 5 logged in from 8.0.0.1"),
    (7, "Copyright held by Alice in this state of things"), (8, "Copyright held by Bob in this state of things"),
    (9, "Copyright held by Carol in this state of things\nits own line is here"), (10, "Copyright held by nobody at all for any reason"),
    (11, "A b."), (12, "A b."), (13, "A b."), (14, None), (15, ""), (None, "All rights reserved here."), (2, "second text of two\nAll rights reserved here."),
]


def test_line_templates(spark):
    frame = spark.createDataFrame(LINES, "doc_id long, text string").withColumn("_id", F.lit(1)).withColumn("n_lines", F.lit(0)).repartition(3)
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in drop_recurring_lines(frame).collect())
    want = Counter({
        (1, LINES[0][1], 2, 0): 1, (2, "second text of two", 2, 1): 2, (3, "third text, of three", 3, 2): 1,
        (4, LINES[3][1], 1, 0): 1, (5, "own words stand here", 2, 1): 1, (6, "", 1, 1): 1,
        (7, LINES[6][1], 1, 0): 1, (8, "", 1, 1): 1, (9, "its own line is here", 2, 1): 1, (10, LINES[9][1], 1, 0): 1,
        (11, "A b.", 1, 0): 1, (12, "A b.", 1, 0): 1, (13, "A b.", 1, 0): 1, (14, None, 0, 0): 1, (15, "", 0, 0): 1, (None, "", 1, 1): 1,
    })
    assert got == want


def dropped_lines(spark, texts):
    """The lines that each document (numbered from 0) loses."""
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = {r.doc_id: r.text for r in drop_recurring_lines(frame).collect()}
    return [list((Counter(t.split("\n")) - Counter(out[i].split("\n"))).elements()) for i, t in enumerate(texts)]


def test_lines_without_spaces(spark):
    said = ["\u7248\u6743\u6240\u6709\u4fb5\u6743\u5fc5\u7a76", "\u3059\u3079\u3066\u306e\u6a29\u5229 \u7559\u4fdd", "\u0e2a\u0e07\u0e27\u0e19\u0e25\u0e34\u0e02\u0e2a\u0e34\u0e17\u0e18\u0e34\u0e4c"]
    texts = ["\n".join([*said, "\u4e00\u4e8c", "A b.", f"the own line of {w}"]) for w in ("ann", "bea", "cyd")]
    assert dropped_lines(spark, texts) == [[], said, said]


def test_lines_without_constants(spark):
    texts = [f"{2000 + i} {7 * i} 3.{i}\n0 0 0 0 {i} 0 0 0\n1 {i} 2 3 4 5 6 {w}\n1 2 3\n9 8  7 6 5\n{i} of {i} rows" for i, w in enumerate(("ann", "bea", "cyd", "dot"))]
    assert dropped_lines(spark, texts) == [[]] + [["1 2 3", "9 8  7 6 5", f"{i} of {i} rows"] for i in (1, 2, 3)]


def test_several_templates_in_a_leaf(spark):
    names = ["Ann", "Bea", "Cyd", "Dot"]
    said = [f"Copyright held by {n} in this state of things" for n in names] + [f"Copyright held by {n} at all for any reason" for n in names]
    said += [f"Copyright held by the firm of {n} {n}son since a very long time" for n in names]
    said += [f"Copyright held by all who ever wrote on {n} and {n}son here" for n in names]
    free = [f"Copyright held by {w}a {w}b {w}c {w}d {w}e {w}f" for w in "pqrstuv"]  # much else in the same leaf
    free += [f"Copyright held by {w}a {w}b {w}c {w}d {w}e {w}f {w}g {w}h {w}i {w}j" for w in "pqrstuv"]
    twice = [f"Copyright held by {n} until the end of it" for n in names[:2]]
    got = dropped_lines(spark, said + free + twice)
    assert got[:16] == [[] if i % 4 == 0 else [t] for i, t in enumerate(said)]
    assert not any(got[16:])


def modelled(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in drop_recurring_lines(frame).collect())
    assert got == Counter(line_model.model(docs))
    return got


def test_lines_against_the_model(spark):
    import random

    con = duckdb.connect()
    given = con.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    given = list({i: (i, t) for i, t in given}.values())
    rng = random.Random(8)
    starts = ["all rights are", "see page 7", "\u7248\u6743 \u6240\u6709 \u4fb5\u6743", "1 2 3"]
    made = []
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(4)):
            size = rng.choice([0, 1, 4, 7, 10, 13])
            said = [rng.choice("abc") if rng.random() < 0.2 else f"w{'xyz'[k % 3]}" for k in range(size)]
            lines.append(rng.choice(starts) + rng.choice([" ", "  ", "\t"]) + " ".join(said))
        made.append((1_000_000 + i, "\n".join(lines)))
    made += [(None, made[0][1]), made[1], made[1]]
    counts = modelled(spark, given + made)
    assert sum(n for _, _, _, n in counts) > 100


def test_a_family_of_near_copies_keeps_one(spark):
    for n in (21, 1000):
        base = [f"w{'abcdefghij'[k % 10]}{'klmnop'[k % 6]}" for k in range(n)]
        said = [" ".join(base[:n // 2 + i] + ["odd"] + base[n // 2 + i + 1:]) for i in range(6)]
        got = dropped_lines(spark, said)
        assert got[0] == [] and [len(x) for x in got[1:]] == [1] * 5
        modelled(spark, list(enumerate(said)))


def test_a_very_long_line_costs_what_its_length_is(spark):
    import time

    took = []
    for n in (2000, 20_000):
        base = [f"w{k % 977}x".replace("0", "o").translate(str.maketrans("123456789", "abcdefghi")) for k in range(n)]
        said = [" ".join(base[:n // 2 + i] + ["odd"] + base[n // 2 + i + 1:]) for i in range(6)]
        began = time.time()
        assert [len(x) for x in dropped_lines(spark, said)] == [0, 1, 1, 1, 1, 1]
        took.append(time.time() - began)
    assert took[1] < 6 * took[0] + 10  # ten times the words; a copy of the line for each place would be a hundred times


def test_line_templates_edges(edge_docs, no_docs):
    out = drop_recurring_lines(edge_docs)
    assert out.columns == [*edge_docs.columns, "n_lines", "n_dropped"]
    assert Counter(r.doc_id for r in out.select("doc_id").collect()) == Counter(i for i, _, _ in EDGE_ROWS)
    assert drop_recurring_lines(no_docs).count() == 0


def test_pipeline_stages(spark, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(language_id, "ROUNDS", 5)
    docs = edge_docs
    before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == edge_docs.columns and stage(spark, no_docs, SMALL).count() == 0
        rows = [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]
        if name == "language_id":
            assert Counter(rows) == Counter((i, t) for i, t in before if any(c.isalpha() for c in t or ""))
        elif name == "line_dedup":
            assert Counter(rows) == Counter((i, t) for i, t, *_ in line_model.model(before))
        elif name == "simhash_near_dedup":
            prints = [fingerprint(t) for _, t in before]
            links = [(a, b) for a in range(len(before)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
            groups = {}
            for root, row in zip(roots_of(len(before), links), before):
                groups.setdefault(root, []).append(row)
            least = [min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()]
            assert Counter(i for i, _ in rows) == Counter(least)
        else:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            assert Counter(rows) == Counter((i, t) for i, t in before if not judged(t, items)[3])
        docs = spark.createDataFrame(out.collect(), out.schema)
        before = rows
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    library = Tokenizer.from_file(default_tokenizer_path())
    pieces, room = Counter(), {}
    for i, t in before:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        ends = list(range(len(ids), 0, -2048))[::-1]
        for k, (a, b) in enumerate(zip([0, *ends], ends)):
            pieces[i, k, a, b - a, np.array(ids[a:b], "<u4").tobytes()] += 1
    got = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == pieces
    for r in got:
        room.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in room.values():  # side by side from 0 on
        spans.sort()
        assert [a for a, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1].tolist()] and sum(n for _, n in spans) <= 2048


def test_pipeline_without_labels(spark, edge_docs):
    """Nothing to learn from: documents with letters stay."""
    for unlabelled in (edge_docs.withColumn("lang", F.lit(None).cast("string")), edge_docs.where("doc_id = 2")):
        rows = [r.text for r in unlabelled.select("text").collect()]
        out = corpus_pipeline.STAGES[0][1](spark, unlabelled.withColumn("lang", F.lit(None).cast("string")), SMALL)
        assert Counter(r.text for r in out.collect()) == Counter(t for t in rows if any(c.isalpha() for c in t or ""))


def test_every_label_is_learned(spark):
    """Labels beyond any round number of them, each with its own letters."""
    said = {f"l{k:03}": "".join(chr(0x61 + (k * 7 + j * (k % 5 + 1)) % 26) for j in range(6)) for k in range(90)}
    docs = spark.createDataFrame([(i, said[k], k) for i, k in enumerate(sorted(said) * 9)], "doc_id long, text string, lang string")
    texts, labels = language_id.sample(docs.repartition(4))
    assert set(labels) == set(said) and len(texts) <= language_id.SAMPLE_DOCS
    few, labels = language_id.sample(docs.unionByName(docs).where("doc_id < 200"))
    assert max(Counter(labels).values()) <= language_id.SAMPLE_DOCS // len(set(labels))


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in rows}
    texts = Counter(docs.values())
    for i, t in docs.items():
        if judged(t, items)[3] and judged(t, items)[1] == judged(t, items)[0]:
            assert i not in kept
    # documents unlike all others, free of benchmark passages, stay: all but the near copies of another
    left = {i: t for i, t, *_ in line_model.model(list(docs.items()))}
    clean = [i for i, t in docs.items() if texts[t] == 1 and any(c.isalpha() for c in t or "") and not judged(t, items)[1]]
    prints = {i: fingerprint(left[i]) for i in docs if any(c.isalpha() for c in docs[i] or "")}
    near = lambda i: any(j < i and (prints[i] ^ prints[j]).bit_count() <= 2 for j in prints)
    assert all(near(i) for i in set(clean) - kept)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    frame = QUERIES[name](spark, SMALL)
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    want = Counter(result.fetchall())
    assert sorted(columns) == sorted(frame.columns)
    assert Counter(tuple(r) for r in frame.select(*columns).collect()) == want
