"""Operator 7, language identification with a bidirectional gated recurrent network.

A forward and a backward GRU read the UTF-8 bytes of a text, in sequences of
``STEPS`` bytes; every position gets a probability for each language from both
states, and a document's probabilities are the mean over all its positions. The
network is trained in numpy by backpropagation through time, on the driver, from
a bounded sample: at most ``SAMPLE_DOCS`` training documents, equally many of each
label (``LEAST_A_LABEL`` at least, so more where there are over 600 labels), the ones with
the least hash of their id, and of each a passage of ``PASSAGE`` characters at a place that a hash decides. Every
document is then read whole, in tasks that hold one block of sequences at a time.

Training documents are those whose ``crc32(doc_id as text) mod 4`` is not 2 and whose
``lang`` is not null; nothing but the text is an input of a prediction.

Edge cases: a null text or one without letters is ``und`` with score 0; without any
training document every text is ``und``; rows without ``doc_id`` are neither trained
on nor held out (null); each row is judged by itself, copies alike; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postclust.llm.bpe import release_memory

STEPS = 64
HIDDEN = 8
BLOCK = 2048           # sequences that run side by side

SAMPLE_DOCS = 2400
LEAST_A_LABEL = 4
SAMPLE_SALTS = 16
PASSAGE = 800

BATCH = 256
ROUNDS = 300
RATE = 0.02
SEED = 7

UNDETERMINED = "und"


def sequences(data: np.ndarray) -> tuple[np.ndarray, int]:
    """The bytes of a text as rows of ``STEPS``, the last one padded; bytes in the last row."""
    rows = -(-len(data) // STEPS)
    out = np.zeros(rows * STEPS, dtype=np.uint8)
    out[:len(data)] = data
    return out.reshape(rows, STEPS), len(data) - (rows - 1) * STEPS


class BiGru:
    """Weights by direction: ``x`` (256 bytes by gates), ``u`` (states by gates); ``w``, ``b``
    of the output. Gates: update and reset (both as tanh of half the sum), candidate."""

    def __init__(self, langs: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        h, n = HIDDEN, len(langs)
        self.langs = langs
        self.p = {"w": rng.normal(0, 0.3, (n, 2 * h)), "b": np.zeros((n, 1))}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.3, (3 * h, 256))
            self.p["u" + d] = rng.normal(0, 0.3, (3 * h, h))
            self.p["c" + d] = np.zeros((h, 1))  # bias inside the reset product
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, d: str, rows: np.ndarray, valid: np.ndarray | None, keep: list | None):
        """States of one direction, step by step: yields ``(t, state)``."""
        x, u, c = self.p["x" + d], self.p["u" + d], self.p["c" + d]
        h2 = 2 * HIDDEN
        h = np.zeros((HIDDEN, len(rows)), dtype=np.float32)
        half = np.float32(0.5)
        for t in range(STEPS) if d == "f" else reversed(range(STEPS)):
            pre = np.take(x, rows[:, t], axis=1)
            m = u @ h
            gates = np.tanh(pre[:h2] + m[:h2])
            gates *= half
            gates += half
            z, r = gates[:HIDDEN], gates[HIDDEN:]
            q = m[h2:] + c
            cand = np.tanh(pre[h2:] + r * q)
            new = z * (h - cand)
            new += cand
            if valid is not None:
                new *= valid[t]
            if keep is not None:
                keep.append((t, h, z, r, q, cand))
            h = new
            yield t, h

    def probabilities(self, rows: np.ndarray, valid: np.ndarray | None) -> np.ndarray:
        """Sum over the positions of a sequence of each language's probability."""
        ahead = [h for _, h in self._run("f", rows, valid, None)]
        w, b = self.p["w"], self.p["b"]
        total = np.zeros((len(self.langs), len(rows)), dtype=np.float32)
        for t, h in self._run("b", rows, valid, None):
            e = w[:, :HIDDEN] @ ahead[t] + w[:, HIDDEN:] @ h + b
            e -= e.max(axis=0)
            np.exp(e, out=e)
            e /= e.sum(axis=0)
            if valid is not None:
                e *= valid[t]
            total += e
        return total

    def gradients(self, rows: np.ndarray, valid: np.ndarray, label: np.ndarray) -> tuple[float, dict]:
        """Mean loss over all positions, and its gradients by backpropagation through time."""
        kept = {"f": [], "b": []}
        states = {d: dict(self._run(d, rows, valid, kept[d])) for d in "fb"}
        w = self.p["w"]
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        back = {"f": {}, "b": {}}
        scale, loss = np.float32(1 / valid.sum()), 0.0
        at = np.arange(len(rows))
        for t in range(STEPS):
            both = np.concatenate([states["f"][t], states["b"][t]])
            e = w @ both + self.p["b"]
            e -= e.max(axis=0)
            e = np.exp(e)
            e /= e.sum(axis=0)
            loss -= float((np.log(e[label, at] + 1e-9) * valid[t]).sum() * scale)
            e[label, at] -= 1
            e *= valid[t] * scale
            g["w"] += e @ both.T
            g["b"] += e.sum(axis=1, keepdims=True)
            dh = w.T @ e
            back["f"][t], back["b"][t] = dh[:HIDDEN], dh[HIDDEN:]
        for d in "fb":
            carry = np.zeros((HIDDEN, len(rows)), dtype=np.float32)
            u = self.p["u" + d]
            slopes, read = [], []
            for t, h, z, r, q, cand in reversed(kept[d]):
                dh = (carry + back[d][t]) * valid[t]
                dz, dcand = dh * (h - cand), dh * (1 - z)
                dn = dcand * (1 - cand * cand)
                dr, dq = dn * q, dn * r
                # a gate is half of one plus tanh: its slope is 2 g (1 - g)
                dpre = np.concatenate([2 * dz * z * (1 - z), 2 * dr * r * (1 - r), dn])
                dm = np.concatenate([dpre[:2 * HIDDEN], dq])
                g["u" + d] += dm @ h.T
                g["c" + d] += dq.sum(axis=1, keepdims=True)
                slopes.append(dpre)
                read.append(rows[:, t])
                carry = dh * z + u.T @ dm
            # summed by the byte read, all steps at once
            read = np.concatenate(read)
            order = np.argsort(read, kind="stable")
            read = read[order]
            begin = np.flatnonzero(np.r_[True, read[1:] != read[:-1]])
            g["x" + d][:, read[begin]] = np.add.reduceat(np.concatenate(slopes, axis=1)[:, order], begin, axis=1)
        return loss, g

    def train(self, texts: list[str], labels: list[int], rounds: int = ROUNDS) -> list[float]:
        """Adam over random batches of sequences; the losses."""
        rng = np.random.default_rng(SEED)
        rows, sizes, label = [], [], []
        for text, y in zip(texts, labels):
            if data := text.encode():
                seq, last = sequences(np.frombuffer(data, dtype=np.uint8))
                rows.append(seq)
                sizes += [STEPS] * (len(seq) - 1) + [last]
                label += [y] * len(seq)
        rows, sizes, label = np.concatenate(rows), np.array(sizes), np.array(label)
        valid = (np.arange(STEPS)[:, None] < sizes).astype(np.float32)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        losses = []
        for i in range(1, rounds + 1):
            pick = rng.integers(0, len(rows), BATCH)
            loss, g = self.gradients(rows[pick], valid[:, pick], label[pick])
            losses.append(loss)
            rate = RATE * (1 - i / (rounds + 1))
            for k, x in self.p.items():
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                x -= (rate * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        return losses

    def documents(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities of each (not empty) text, by language."""
        data = [np.frombuffer(t.encode(), dtype=np.uint8) for t in texts]
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        counts = -(-sizes // STEPS)
        rows = np.concatenate([sequences(d)[0] for d in data])
        doc = np.repeat(np.arange(len(data)), counts)
        ends = np.cumsum(counts) - 1
        length = np.full(len(rows), STEPS)
        length[ends] = sizes - (counts - 1) * STEPS
        out = np.zeros((len(data), len(self.langs)))
        # whole sequences need no mask; a text's last one mostly does
        for whole in (True, False):
            which = np.flatnonzero((length == STEPS) == whole)
            for i in range(0, len(which), BLOCK):
                part = which[i:i + BLOCK]
                valid = None if whole else (np.arange(STEPS)[:, None] < length[part]).astype(np.float32)
                np.add.at(out, doc[part], self.probabilities(rows[part], valid).T)
        return out / sizes[:, None]


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def sample(docs: DataFrame) -> tuple[list[str], list[str]]:
    """Training sample: passages and their labels, of every label there is. It has at most
    ``SAMPLE_DOCS`` rows, or ``LEAST_A_LABEL`` a label where labels are very many."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    langs = rows.select("lang").distinct().count()
    if not langs:
        return [], []
    each = max(LEAST_A_LABEL, SAMPLE_DOCS // langs)
    # two limits, so that one task meets at most SAMPLE_SALTS * each rows of a label, however many tasks scan it
    salted = rows.select("lang", "doc_id").withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SAMPLE_SALTS)))
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = salted.withColumn("n", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("n") <= each)
    ids = ids.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("n") <= each)
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.greatest(F.length("text") - PASSAGE, F.lit(0)) + 1) + 1
    passage = rows.select("lang", "doc_id", F.substr("text", place.cast("int"), F.lit(PASSAGE)).alias("passage"))
    wanted = F.broadcast(ids.select("lang", "doc_id").distinct())  # as many rows as the sample at most
    # rows alike in label and id bring their passages too: each label keeps its first ones
    taken = passage.join(wanted, ["lang", "doc_id"], "left_semi").distinct()
    first = Window.partitionBy("lang").orderBy(*order, "passage")
    taken = taken.withColumn("n", F.row_number().over(first)).where(F.col("n") <= each).orderBy("doc_id", "lang", "passage").collect()
    return [r["passage"] for r in taken], [r["lang"] for r in taken]


def fit(docs: DataFrame) -> BiGru | None:
    texts, labels = sample(docs)
    if not texts:
        return None
    langs = sorted(set(labels))
    model = BiGru(langs)
    model.train(texts, [langs.index(x) for x in labels])
    return model


#: Bytes of text judged together in a task.
BYTES_AT_ONCE = 4_000_000


def has_letters(text: Column) -> Column:
    return F.rlike(text, F.lit(r"\p{L}"))


def predict(docs: DataFrame, model: BiGru | None) -> DataFrame:
    """All columns of ``docs`` as ``row``, with ``lang_pred`` and ``score``."""

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            pred, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            at, part, size = [], [], 0

            def done() -> None:
                for i, p in zip(at, model.documents(part)):
                    best = int(p.argmax())
                    pred[i], score[i] = model.langs[best], min(1.0, float(p[best]))

            for i, t in enumerate(texts):
                if t and model is not None:
                    at.append(i)
                    part.append(t)
                    size += len(t)
                    if size >= BYTES_AT_ONCE:
                        done()
                        at, part, size = [], [], 0
            if part:
                done()
            yield pd.DataFrame({"lang_pred": pred, "score": score})
        release_memory()

    text = F.when(has_letters(F.col("text")), F.col("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), judge(text).alias("judged"))
    return rows.select("row", "judged.lang_pred", "judged.score")


def identify(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row, by a model fit on ``docs``."""
    kept = docs.select("doc_id", "text", "lang")
    judged = predict(kept.select("doc_id", "text"), fit(kept))
    return judged.select("row.doc_id", "lang_pred", "score").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
