"""Operators 1, 2 and 5 against the tokenizers library."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from edge_rows import EDGE_ROWS

from postclust.llm.best_fit import CAPACITY, cut, pack, plan_slots
from postclust.llm.bpe import ChunkEncoder, default_tokenizer_path
from postclust.llm.token_counts import RankMerger, token_counts
from postclust.llm.wavelet import WaveletMatrix, count_token, decode, find_token, read_shards, round_trip, token_at, with_starts, write_shards


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


PIECES = ["a ", "  ", "\n", " \n", "'s", "<|endoftext|>", "　", "x\t", "word", "12", ", ", "\x1c", " \x85", "aaaaaa", "ß", "====", "Ä.", "a,"]


def test_chunks_and_merges_match_the_library(library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(400)] + [None, "", "x" * 5000, "ab" * 3000]
    path = default_tokenizer_path()
    want = [ids_of(library, t) for t in texts]
    encoder, merger = ChunkEncoder(path), RankMerger(path)
    for _ in range(2):  # again with what is remembered
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_batch(texts)] == want
        assert merger.count_batch(texts) == [len(w) for w in want]


def test_full_memory_keeps_results_right(library, monkeypatch):
    import postclust.llm.bpe as bpe

    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 5)
    monkeypatch.setattr(bpe, "CACHE_CHUNK_CHARS", 4)
    monkeypatch.setattr(bpe, "KNOWN_CHUNKS", 5)
    encoder, merger = ChunkEncoder(default_tokenizer_path()), RankMerger(default_tokenizer_path())
    for text in ("one two three four five six seven", "longer words again, longer words.", "one longer two words", "on, on. two one one six six fi ve a b") * 2:
        assert np.frombuffer(encoder.encode_batch([text])[0], "<u4").tolist() == ids_of(library, text)
        assert merger.count_batch([text]) == [len(ids_of(library, text))]
        assert len(encoder.known.first) <= 12


def test_batches_of_little(library):
    encoder = ChunkEncoder(default_tokenizer_path())
    for texts in ([], [None], [""], ["", None, ""], [" "], ["<|endoftext|>"], ["", "<|endoftext|>", None, "a"], ["  ", "a  "]):
        assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_batch(texts)] == [ids_of(library, t) for t in texts]


def test_one_half_of_a_hash_does_not_decide(library):
    encoder = ChunkEncoder(default_tokenizer_path())
    encoder.table[0] = 0  # the first halves are all alike
    for text in ("a bc, def. bc def a xyz", "bc xyz xyz, a. def ghi", "a bc, def. bc def a xyz"):
        assert np.frombuffer(encoder.encode_batch([text])[0], "<u4").tolist() == ids_of(library, text)


def test_every_letter_class(library):
    """Pre-tokenization classes of the pattern and of the library agree."""
    points = [c for c in range(0, 0x3000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}1 {chr(c)}b  {chr(c)} !{chr(c)}{chr(c)}\n x" for c in points]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert RankMerger(default_tokenizer_path()).count_batch(texts) == want
    assert [len(b) // 4 for b in ChunkEncoder(default_tokenizer_path()).encode_batch(texts)] == want


def test_token_counts(edge_docs, no_docs, library):
    got = Counter(map(tuple, token_counts(edge_docs).collect()))
    want = Counter((i, len((t or "").encode()), n := len(ids_of(library, t)), n > 1024) for i, t, _ in EDGE_ROWS)
    assert got == want
    assert token_counts(no_docs).count() == 0


def test_cut():
    assert cut(5, 8) == [(0, 5)] and cut(8, 8) == [(0, 8)] and cut(17, 8) == [(0, 1), (1, 8), (9, 8)]


def test_plan_equals_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.choice([7, 16, 40])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 80))]
        bins = []
        for length in sorted(lengths, reverse=True):
            fit = [b for b in bins if capacity - sum(b) >= length]
            best = min(fit, key=lambda b: capacity - sum(b)) if fit else None
            if best is None:
                bins.append(best := [])
            best.append(length)
        plan = plan_slots(Counter(lengths), capacity)
        filled = {}
        for length, first, n, each, sequence, offset in plan:
            for r in range(n):
                filled.setdefault(sequence + r // each, []).append((offset + r % each * length, length))
        assert Counter(l for s in filled.values() for _, l in s) == Counter(lengths)
        assert len(filled) == len(bins)
        for slots in filled.values():
            at = 0
            for offset, length in sorted(slots):
                assert offset == at
                at += length
            assert at <= capacity


def test_pack(edge_docs, no_docs, library):
    rows = pack(edge_docs).collect()
    want = Counter()
    for i, t, _ in EDGE_ROWS:
        ids = ids_of(library, t) + [0]
        want.update((i, k, s, n, tuple(ids[s:s + n])) for k, (s, n) in enumerate(cut(len(ids), CAPACITY)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for slots in by_sequence.values():
        assert [o for o, _ in sorted(slots)] == [sum(l for _, l in sorted(slots)[:k]) for k in range(len(slots))]
        assert sum(l for _, l in slots) <= CAPACITY
    assert pack(no_docs).count() == 0


def test_wavelet_matrix():
    rng = np.random.default_rng(0)
    for n, width in ((0, 4), (1, 4), (700, 5), (5000, 11)):
        ids = rng.integers(0, 1 << width, n)
        m = WaveletMatrix.build(ids, width)
        assert m.ids().tolist() == ids.tolist()
        for i in rng.integers(0, n, 20) if n else ():
            assert m.access(int(i)) == ids[i]
        for token in {0, 3, (1 << width) - 1}:
            places = np.flatnonzero(ids == token).tolist()
            assert m.occurrences(token) == places and m.rank(token) == len(places)
            assert m.rank(token, n // 2) == int((ids[:n // 2] == token).sum())
        assert m.rank(1 << width) == 0
        with pytest.raises(IndexError):
            m.select(0, n)


def test_round_trip(edge_docs, no_docs, library):
    rows = round_trip(edge_docs).collect()
    assert Counter((r.doc_id, zlib.crc32(r.ids)) for r in rows) == Counter(
        (i, zlib.crc32(np.array(ids_of(library, t) + [2], "<u4").tobytes())) for i, t, _ in EDGE_ROWS)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids) // 4
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert round_trip(no_docs).count() == 0


def test_find_token(spark, edge_docs, library, tmp_path):
    path = str(tmp_path / "shards")
    docs = edge_docs.where("doc_id = 10 or doc_id = 7")
    write_shards(docs, path, block_tokens=50)
    shards = read_shards(spark, path)
    assert decode(shards).count() == 2
    token = ids_of(library, " alpha")[0]
    got = sorted((r.doc_id, r.place) for r in find_token(shards, token).collect())
    text = dict((i, t) for i, t, _ in EDGE_ROWS)[10]
    assert got == [(10, k) for k, x in enumerate(ids_of(library, text)) if x == token]


def test_lookups_on_written_files(spark, edge_docs, library, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(edge_docs.repartition(4), path, block_tokens=70)
    shards = read_shards(spark, path)
    rows = with_starts(shards, decode(shards)).orderBy("start").collect()
    every = [int(x) for r in rows for x in np.frombuffer(r.ids, "<u4")]
    assert shards.count() > 3
    for token in (2, ids_of(library, " alpha")[0], ids_of(library, "ab")[0], 50256, 49000):
        for upto in (None, 0, 1, 69, 500, len(every) - 1, len(every), len(every) + 9):
            assert count_token(shards, token, upto) == every[:upto].count(token)
    places = [0, 1, 69, 70, 71, 1234, len(every) - 1, len(every), -1]
    assert token_at(shards, places) == {p: every[p] for p in places if 0 <= p < len(every)}
    assert token_at(shards, []) == {} and token_at(shards.where("false"), [0]) == {} and count_token(shards.where("false"), 2) == 0
