"""Byte-pair encoding of whole texts, with the distinct chunks of a text cached.

A text is cut at single spaces that stand between two other characters that are
not white space. The pre-tokenization pattern starts a new piece at each of
those spaces, whatever stands before it, so the chunks can be encoded one by
one and the ids put together; words repeat, so most chunks are known already.
"""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER_FILE = "byte_bpe_50k.json"

#: Chunks a worker process remembers (some 50 MB).
CACHE_CHUNKS = 250_000
#: Longer chunks are not remembered.
CACHE_CHUNK_CHARS = 64
#: Characters of text encoded together.
BATCH_CHARS = 3_000_000

_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def chunk_lists(texts: list[str]) -> tuple[list[list[str]], set[str]]:
    """Chunks of each text, and the distinct ones among all but the first of a
    text. Those stand after a space, which belongs to them."""
    parts = [t.split(" ") for t in texts]
    distinct = set().union(*parts)
    # an empty chunk, or one that touches other white space: cut such texts only where it is safe
    if bad := {c for c in distinct if not c or c.strip() != c}:
        parts = [p if bad.isdisjoint(p) else _SAFE_SPACE.split(t) for p, t in zip(parts, texts)]
        distinct = set().union(*parts)
    return parts, distinct


class Memory:
    """What is known of the chunks met lately. When it is full, what the present batch
    does not use goes; chunks too long to be kept go with the next batch."""

    def __init__(self):
        self.values: dict = {}
        self.long: list[str] = []

    def of(self, distinct: set[str], learn) -> dict:
        """Values of (at least) all of ``distinct``; ``learn`` gives those of new ones."""
        for c in self.long:
            self.values.pop(c, None)
        if len(self.values) > CACHE_CHUNKS:
            self.values = {c: v for c, v in self.values.items() if c in distinct}
        new = list(distinct - self.values.keys())
        self.long = [c for c in new if len(c) > CACHE_CHUNK_CHARS]
        if new:
            self.values.update(learn(new))
        return self.values


#: Chunks that an encoder remembers (some 40 bytes each).
KNOWN_CHUNKS = 600_000
#: Chunks that the library encodes as one text.
JOINED_CHUNKS = 2_000

_MARKS = b".,"
_LETTER_BYTE = np.zeros(256, dtype=bool)
_LETTER_BYTE[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


class Known:
    """Ids of chunks by a 128-bit hash, in flat arrays ordered by its first half: second half,
    place and number of ids, and how often the chunk was looked up of late."""

    def __init__(self):
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.size, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Places of hashes (-1: not known)."""
        if not len(self.first):
            return np.full(len(first), -1)
        at = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
        return np.where((self.first[at] == first) & (self.second[at] == second), at, -1)

    def add(self, first: np.ndarray, second: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        if len(self.first) + len(first) > KNOWN_CHUNKS:
            self._forget()
        start = np.cumsum(size) - size + len(self.ids)
        joined = [np.concatenate(x) for x in ((self.first, first), (self.second, second), (self.start, start), (self.size, size),
                                              (self.uses, np.zeros(len(first), np.int32)))]
        order = np.argsort(joined[0], kind="stable")
        self.first, self.second, self.start, self.size, self.uses = (x[order] for x in joined)
        self.ids = np.concatenate([self.ids, ids])

    def _forget(self) -> None:
        """Keep the half that was used most; all uses count half from now on."""
        keep = np.sort(np.argsort(self.uses, kind="stable")[len(self.uses) - KNOWN_CHUNKS // 2:])
        at = spread(self.start[keep], self.size[keep])
        self.first, self.second, self.size = self.first[keep], self.second[keep], self.size[keep]
        self.uses = self.uses[keep] // 2
        self.ids, self.start = self.ids[at], np.cumsum(self.size) - self.size


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``start``, ``start + 1``, ... of each span, ``size`` of them, one span after another."""
    sizes = sizes.astype(np.int64)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class ChunkEncoder:
    """Ids of whole texts as the tokenizers library gives them, without added special
    tokens. A special string inside a text is handled as the library does by default (such
    texts go to it whole).

    A slice of texts is cut and its distinct chunks numbered in Arrow. Those whose ids are known
    are looked up by hash; the library encodes the others, many as one text, and the tokens'
    byte lengths tell where a chunk ends. A letter's full stop or comma is a piece of its own, so
    a chunk that ends so is looked up without it. The ids of all texts are then gathered at once.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.token_bytes = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.token_bytes[i] = len(token)  # a character stands for a byte
        self.marks = np.array([self._whole(chr(m))[0] for m in _MARKS], dtype=np.uint32)
        self.known = Known()
        # a byte's share in the hash of a chunk, by its place; longer chunks are not remembered
        self.table = np.random.default_rng(0).integers(0, 1 << 64, (2, CACHE_CHUNK_CHARS, 256), dtype=np.uint64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _encode_joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that stand after a space, end to end, and their number for each."""
        groups = [chunks[i:i + JOINED_CHUNKS] for i in range(0, len(chunks), JOINED_CHUNKS)]
        encoded = self.tokenizer.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *[np.array(e.ids, dtype=np.uint32) for e in encoded]])
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks], dtype=np.int64)
        token_ends = np.cumsum(self.token_bytes[ids])
        after = np.searchsorted(token_ends, ends) + 1
        return ids, np.diff(np.r_[0, after]).astype(np.int32)

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.StringArray, np.ndarray]:
        """Number of chunks of each text, the distinct chunks, and the number of each chunk in order."""
        lists = pc.split_pattern(texts, " ")
        coded = pc.dictionary_encode(lists.flatten())
        chunks, index = coded.dictionary, coded.indices.to_numpy()
        counts = np.diff(lists.offsets.to_numpy())
        bad = pc.or_(pc.equal(pc.binary_length(chunks), 0), pc.not_equal(pc.utf8_trim_whitespace(chunks), chunks)).to_numpy(zero_copy_only=False)
        if bad.any():
            # an empty chunk, or one that touches other white space: cut such texts only where it is safe
            own = np.repeat(np.arange(len(texts)), counts)
            unsafe = np.unique(own[bad[index]])
            parts = [_SAFE_SPACE.split(t) for t in texts.take(pa.array(unsafe)).to_pylist()]
            left = ~np.isin(own, unsafe)
            added = pc.dictionary_encode(pa.array([c for p in parts for c in p], pa.string()))
            index = np.concatenate([index[left], added.indices.to_numpy() + len(chunks)])
            own = np.concatenate([own[left], np.repeat(unsafe, [len(p) for p in parts])])
            order = np.argsort(own, kind="stable")
            index, counts = index[order], np.bincount(own, minlength=len(texts))
            chunks = pa.concat_arrays([chunks, added.dictionary])
        return counts, chunks, index

    def _ids_of(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of chunks after a space: an array of ids, and the start and number of each chunk's."""
        data = np.frombuffer(chunks.buffers()[2] or b"", dtype=np.uint8)
        data = data if len(data) else np.zeros(1, np.uint8)  # only empty chunks
        offsets = np.frombuffer(chunks.buffers()[1], dtype=np.int32)[chunks.offset:chunks.offset + len(chunks) + 1].astype(np.int64)
        begin, length = offsets[:-1], np.diff(offsets)
        last, before = data[np.maximum(offsets[1:] - 1, 0)], data[np.maximum(offsets[1:] - 2, 0)]
        marked = (length > 1) & np.isin(last, np.frombuffer(_MARKS, np.uint8)) & _LETTER_BYTE[before]
        length = length - marked
        short = (length <= CACHE_CHUNK_CHARS) & (length > 0)
        at = spread(begin[short], length[short])
        place = at - np.repeat(begin[short], length[short])
        first, second = np.zeros(len(chunks), np.uint64), np.zeros(len(chunks), np.uint64)
        bounds = np.cumsum(length[short]) - length[short]
        if len(at):
            first[short], second[short] = (np.add.reduceat(t[place, data[at]], bounds) for t in self.table)
        known = np.where(short, self.known.find(first, second), -1)

        # chunks to encode: the long ones, and of short ones with one hash the first
        new = np.flatnonzero(known < 0)
        _, pick, same = np.unique(np.where(short[new], first[new], new.astype(np.uint64)), return_index=True, return_inverse=True)
        if (short[new] & (second[new] != second[new[pick[same]]])).any():
            pick = same = np.arange(len(new))  # hashes alike in one half only: each for itself
        learn = new[pick]
        whole = chunks.take(pa.array(learn))
        stems = pc.if_else(pa.array(marked[learn]), pc.utf8_slice_codeunits(whole, 0, -1), whole)
        ids, size = self._encode_joined(stems.to_pylist())
        start = np.cumsum(size) - size

        # all ids end to end: the known, the new, the marks
        base = len(self.known.ids)
        starts, sizes = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        found = known >= 0
        starts[found], sizes[found] = self.known.start[known[found]], self.known.size[known[found]]
        starts[new], sizes[new] = base + start[same], size[same]
        pool = np.concatenate([self.known.ids, ids])
        self.known.uses[known[found]] += 1
        kept = short[learn]
        if kept.any():
            self.known.add(first[learn][kept], second[learn][kept], size[kept], ids[spread(start[kept], size[kept])])
        if marked.any():
            # put the mark's id behind the ids of a marked chunk
            total = sizes + marked
            out = np.zeros(int(total.sum()), np.uint32)
            to = np.cumsum(total) - total
            out[spread(to, sizes)] = pool[spread(starts, sizes)]
            out[(to + sizes)[marked]] = self.marks[(last[marked] == _MARKS[1]).astype(np.int64)]
            return out, to, total
        return pool, starts, sizes

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of each text's. A null text has none."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        special = np.zeros(len(texts), dtype=bool)
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        whole = {int(i): self._whole(texts[int(i)].as_py()) for i in np.flatnonzero(special)}
        if whole:
            texts = pc.if_else(pa.array(special), "", texts)
        counts, chunks, index = self._cut(texts)
        heads = np.cumsum(counts) - counts
        # the first chunk of a text has no space before it
        said = chunks.take(pa.array(index[heads])).to_pylist()
        distinct = {c: i for i, c in enumerate(dict.fromkeys(said))}
        first = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(list(distinct), add_special_tokens=False)]
        ids, start, size = self._ids_of(chunks)
        starts, sizes = start[index], size[index]
        n = np.fromiter(map(len, first), dtype=np.int64, count=len(first))
        which = np.fromiter((distinct[c] for c in said), dtype=np.int64, count=len(said))
        starts[heads], sizes[heads] = len(ids) + (np.cumsum(n) - n)[which], n[which]
        # special texts: one chunk each
        at = len(ids) + int(n.sum())
        for i, own in whole.items():
            starts[heads[i]], sizes[heads[i]] = at, len(own)
            at += len(own)
        pool = np.concatenate([ids, *first, *whole.values()])
        per_text = np.add.reduceat(sizes, heads) if len(heads) else np.zeros(0, np.int64)
        return pool[spread(starts, sizes)], per_text

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        if not texts:
            return []
        ids, n = self.encode_array(pa.array(texts, pa.string()))
        raw, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(n)
        return [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


def text_batches(texts: list[str | None], chars: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of ``texts`` of about ``chars`` characters each."""
    return size_batches([len(t or "") for t in texts], chars)


def size_batches(sizes: list[int], most: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of about ``most`` together."""
    begin = size = 0
    for i, n in enumerate(sizes):
        size += n
        if size >= most:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def array_batches(texts: pa.Array, most: int = BATCH_CHARS) -> Iterator[slice]:
    """Slices of an Arrow array of texts of about ``most`` bytes each."""
    return size_batches(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), most)


def release_memory() -> None:
    """Give back what a worker process holds but doesn't use; for the end of a task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker process's encoder, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
