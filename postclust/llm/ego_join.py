"""Operator 8, embedding near-dedup by an epsilon grid order join.

Unit vectors within cosine ``COSINE`` are within ``EPS`` of each other, and so are their
projections on any orthonormal axes. The axes are the leading principal ones of a bounded
sample (``SAMPLE`` vectors; any axes give exact results, good ones skip more). Vectors are
sorted by label and by grid cells of side ``EPS`` on these axes, and cut into blocks of
at most ``BLOCK``: intervals of the epsilon grid order. Blocks whose bounding boxes are
further apart than ``EPS`` are provably distant and never meet. Two blocks that may be near
are joined recursively: each interval is halved, distant halves are skipped, and what is
left is compared by double precision cosines.

Equal vectors (of one label) are one class from the start, so a group of copies is compared
once. A pair of blocks returns the links of each class as a count, and a spanning forest of
them, never the pairs themselves.

Edge cases: null or empty vectors, zero vectors and those with null or non-finite
components, and vectors without label, link with nothing; vectors of different length never
link; repeated rows are copies and link; rows without ``vec_id`` link like others but name no
component (null if none of it has an id); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postclust.llm.common import counted_join, materialize, salted_lookup
from postclust.llm.components import connected_components

COSINE = 0.98

#: Vectors that the axes are fit on, and the number of axes.
SAMPLE = 4000
AXES = 6

#: Vectors of a block, and of the intervals that are no longer halved.
BLOCK = 1024
LEAF = 128

#: Allowance for rounding in the tests of distance; none in the cosine itself.
SLACK = 1e-9


def epsilon(cosine: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def unit_vectors(rows: DataFrame) -> DataFrame:
    """``(vec_id, label, dim, digest, unit)``: unit vectors (64-bit floats) and a digest of
    the vector; both null where it can't link."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, digests, units = [], [], []
            for v in batch.column("embedding").to_pylist():
                x = np.array([np.nan if c is None else c for c in v or []], dtype=np.float64)
                with np.errstate(all="ignore"):
                    # scaled first, so that no square over- or underflows
                    top = np.abs(x).max() if len(x) else 0.0
                    u = x / top if np.isfinite(top) and top > 0 else None
                dims.append(len(x))
                if u is None:
                    digests.append(None)
                    units.append(None)
                else:
                    digests.append(hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest())
                    units.append((u / np.sqrt(u @ u)).tobytes())
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "label": batch.column("label"), "dim": pa.array(dims, pa.int32()),
                "digest": pa.array(digests, pa.binary()), "unit": pa.array(units, pa.binary())})

    chosen = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    return chosen.mapInArrow(prepare, "vec_id long, label long, dim int, digest binary, unit binary")


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Leading axes by dimension, from the ``SAMPLE`` classes of least hash."""
    taken = classes.orderBy(F.xxhash64("digest"), "digest").select("dim", "unit").limit(SAMPLE).collect()
    axes = {}
    for dim in {r["dim"] for r in taken}:
        x = np.array([np.frombuffer(r["unit"]) for r in taken if r["dim"] == dim])
        axes[dim] = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :AXES].copy()
    return axes


def projector(axes: dict[int, np.ndarray]):
    def of(dim: int) -> np.ndarray:
        return axes[dim] if dim in axes else np.eye(dim)[:, :AXES]

    return of


def with_cells(classes: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """Classes with the grid cells of their projections."""
    of = projector(axes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [np.floor(np.frombuffer(u) @ of(d) / eps).astype(np.int32).tolist()
                     for u, d in zip(batch.column("unit").to_pylist(), batch.column("dim").to_pylist())]
            yield batch.append_column("cells", pa.array(cells, pa.list_(pa.int32())))

    chosen = classes.select("class", "label", "dim", "size", "unit")
    return chosen.mapInArrow(place, "class long, label long, dim int, size long, unit binary, cells array<int>")


def ordered_blocks(placed: DataFrame, axes: dict[int, np.ndarray]) -> DataFrame:
    """Blocks of the epsilon grid order with their bounding boxes on the axes."""
    of = projector(axes)
    kind = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("low", pa.list_(pa.float64())),
                      ("high", pa.list_(pa.float64())), ("classes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                      ("units", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, group = 0, [], None

        def closed() -> pa.RecordBatch:
            x = np.frombuffer(b"".join(r[2] for r in held)).reshape(len(held), group[1])
            p = x @ of(group[1])
            block = TaskContext.get().partitionId() << 32 | number
            row = [block, *group, p.min(axis=0).tolist(), p.max(axis=0).tolist(), [r[0] for r in held], [r[1] for r in held], x.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, kind)], schema=kind)

        for batch in batches:
            for class_, label, dim, size, unit in zip(*(batch.column(c).to_pylist() for c in ("class", "label", "dim", "size", "unit"))):
                if held and (len(held) == BLOCK or group != (label, dim)):
                    yield closed()
                    number, held = number + 1, []
                group = (label, dim)
                held.append((class_, size, unit))
        if held:
            yield closed()

    order = ["label", "dim", "cells", "class"]
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(cut, "block long, label long, dim int, low array<double>, high array<double>, "
                                 "classes array<long>, sizes array<long>, units binary")


def near_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """``(a, b)``, a <= b: blocks of one label whose boxes are within ``eps``. They meet by
    the cells of the first axis that their boxes touch."""
    box = blocks.select("block", "label", "dim", "low", "high")
    first, last = F.floor(F.col("low")[0] / eps), F.floor(F.col("high")[0] / eps)
    left = box.select(F.col("block").alias("a"), "label", "dim", F.col("low").alias("a_low"), F.col("high").alias("a_high"),
                      F.explode(F.sequence(first, last)).alias("cell"))
    right = box.select(F.col("block").alias("b"), "label", "dim", F.col("low").alias("b_low"), F.col("high").alias("b_high"),
                       F.explode(F.sequence(first - 1, last + 1)).alias("cell"))
    gap = F.expr("aggregate(arrays_zip(a_low, a_high, b_low, b_high), 0D, (d, x) -> "
                 "d + pow(greatest(x.a_low - x.b_high, x.b_low - x.a_high, 0D), 2))")
    return left.join(right, ["label", "dim", "cell"]).where((F.col("a") <= F.col("b")) & (gap <= eps * eps + SLACK)).select("a", "b").distinct()


def join_intervals(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, same: bool, cosine: float, eps: float) -> np.ndarray:
    """Which vectors of two sorted intervals link (of one with itself: each pair once)."""
    near = np.zeros((len(x), len(y)), dtype=bool)
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if same and d <= a:
            continue
        gap = np.maximum(0, np.maximum(px[a:b].min(axis=0) - py[c:d].max(axis=0), py[c:d].min(axis=0) - px[a:b].max(axis=0)))
        if gap @ gap > eps * eps + SLACK:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            near[a:b, c:d] = x[a:b] @ y[c:d].T >= cosine
        elif b - a >= d - c:
            todo += [(a, (a + b) // 2, c, d), ((a + b) // 2, b, c, d)]
        else:
            todo += [(a, b, c, (c + d) // 2), (a, b, (c + d) // 2, d)]
    return np.triu(near, 1) if same else near


def forest(near: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Links (row, column) that hold the rows and columns together as all of ``near`` do."""
    n = len(near)
    parent = list(range(n + near.shape[1]))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    shift = 0 if same else n
    for i, j in zip(*(k.tolist() for k in np.nonzero(near))):
        a, b = root(i), root(shift + j)
        if a != b:
            parent[b] = a
            kept.append((i, j))
    return kept


def block_links(pairs: DataFrame, blocks: DataFrame, axes: dict[int, np.ndarray], cosine: float, eps: float) -> DataFrame:
    """Rows ``(a, b, links)``: a class and the vectors linked to it (b null), or a link (links null)."""
    of = projector(axes)

    def side(name: str) -> DataFrame:
        return blocks.select(F.col("block").alias(name), F.struct("dim", "classes", "sizes", "units").alias(f"of_{name}"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                one, two = row["of_a"], row["of_b"]
                x, y = (np.frombuffer(r["units"]).reshape(-1, r["dim"]) for r in (one, two))
                p = of(one["dim"])
                near = join_intervals(x, y, x @ p, y @ p, row["a"] == row["b"], cosine, eps)
                if not near.any():
                    continue
                ids = (np.array(one["classes"]), np.array(two["classes"]))
                sums = (near @ np.array(two["sizes"], dtype=np.int64), np.array(one["sizes"], dtype=np.int64) @ near)
                links = forest(near, row["a"] == row["b"])
                a = [k for k, n in ((ids[0], sums[0]), (ids[1], sums[1])) for k in k[n > 0].tolist()]
                counts = [n for s in sums for n in s[s > 0].tolist()]
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(a + [int(ids[0][i]) for i, _ in links], pa.int64()),
                    "b": pa.array([None] * len(a) + [int(ids[1][j]) for _, j in links], pa.int64()),
                    "links": pa.array(counts + [None] * len(links), pa.int64())})

    met = pairs.join(side("a"), "a").join(side("b"), "b")
    return met.mapInArrow(joined, "a long, b long, links long")


def near_vectors(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    eps = epsilon(cosine)
    vectors = materialize(unit_vectors(rows), "vectors")
    linkable = vectors.where("label is not null and digest is not null")
    classes = materialize(linkable.groupBy("label", "digest").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("size"), F.first("dim").alias("dim"), F.first("unit").alias("unit"),
    ).withColumn("class", F.monotonically_increasing_id()), "vector-classes")

    axes = principal_axes(classes)
    blocks = materialize(ordered_blocks(with_cells(classes, axes, eps), axes), "blocks")
    pairs = materialize(near_blocks(blocks, eps), "block-pairs")
    found = materialize(block_links(pairs, blocks, axes, cosine, eps), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "class")

    rooted = classes.select("class", "label", "digest", "least", "size").join(roots, "class", "left").join(counts, "class", "left")
    rooted = materialize(rooted.withColumn("root", F.coalesce("root", "class")), "vector-roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = salted_lookup(rooted, "root", named, ["class"]).select(
        "label", "digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id", "size")
    linked = counted_join(linkable.select("vec_id", "label", "digest"), ["label", "digest"], materialize(by_class, "by-class"), "size")
    alone = vectors.where("label is null or digest is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.select("vec_id", "n_links", "component_id").unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
