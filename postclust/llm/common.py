"""Helpers shared by the corpus operators: tables in the shared folder, joins
that survive hot keys, and joins with a list of checked size."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postclust.session import ensure_checkpoint_dir

#: Bytes of a list that may be broadcast, as ``may_broadcast`` counts them. Longer lists
#: are joined by shuffling both sides.
BROADCAST_BYTES = 16_000_000

#: Tasks over which the rows of one key are spread in ``salted_lookup``.
SALTS = 64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this package if nothing else does: unless it is on
    PYTHONPATH or in the working folder, Spark distributes it as a zip file."""
    root = Path(__file__).resolve().parents[2]
    app = spark.sparkContext.applicationId
    if app in _shipped or str(root) in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="postclust-"), "postclust.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "postclust").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: the one the cluster names
    in ``spark.checkpoint.dir``, else the warehouse."""
    return ensure_checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Lists that take the paths of tables as they are written, the innermost last.
_noted: list[list[str]] = []


@contextmanager
def noted_tables() -> Iterator[list[str]]:
    """The paths of the tables that ``materialize`` writes within the block."""
    _noted.append([])
    try:
        yield _noted[-1]
    finally:
        _noted.pop()


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``materialize`` has written and that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks only. The table
    stays for as long as the folder does, unless someone notes and drops it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _noted:
        _noted[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def salted_lookup(rows: DataFrame, key: str, table: DataFrame, salt_by: list[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to ``table`` (at most one row per ``key``) although one key
    may hold any share of ``rows``.

    The rows of a key are spread over ``SALTS`` tasks by a hash of ``salt_by``.
    Only the (key, salt) pairs that occur meet the table, at most ``SALTS`` per
    key; the second join is then on (key, salt).
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int"))
    wanted = salted.select(key, "_salt").distinct()
    found = wanted.join(table, key, "inner")
    return salted.join(found, [key, "_salt"], how).drop("_salt")


def fixed_bytes(kind: T.StructType) -> int:
    """Bytes of a row in Spark's format without what strings and arrays hold: a word of null
    bits and 8 bytes a field, structs inside likewise."""
    return 8 + sum(8 + (fixed_bytes(f.dataType) if isinstance(f.dataType, T.StructType) else 0) for f in kind.fields)


def may_broadcast(listed: DataFrame) -> bool:
    """Whether ``listed`` (a table, or cheap to make) is measured to be small enough for a broadcast:
    its rows, what its strings hold, and as much again for the hash table."""
    texts = [F.octet_length(f"`{f.name}`") for f in listed.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    lists = [8 * F.size(f"`{f.name}`") for f in listed.schema.fields if isinstance(f.dataType, T.ArrayType)]
    wide = sum((F.coalesce(c, F.lit(0)).cast("long") for c in [*texts, *lists]), F.lit(fixed_bytes(listed.schema)).cast("long"))
    return (listed.agg(F.sum(2 * wide)).first()[0] or 0) <= BROADCAST_BYTES


def keep_listed(rows: DataFrame, listed: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Rows whose ``keys`` are in ``listed`` (``left_anti``: are not). The list is measured:
    up to ``BROADCAST_BYTES`` it is broadcast, so that the (wide) rows stay where they
    are, beyond that both sides are shuffled."""
    return rows.join(F.broadcast(listed) if may_broadcast(listed) else listed, keys, how)


def row_keyed(rows: DataFrame) -> DataFrame:
    """``(key, row)``: each row as one struct with a number of its own, written once so
    that the number stays. Names of its columns can't clash with others."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    return materialize(rows.select(F.monotonically_increasing_id().alias("key"), row), "rows")


#: A key is hot if it holds more than this share of all rows; so at most 1,000 are.
HOT_SHARE = 0.001


def counted_join(rows: DataFrame, keys: list[str], table: DataFrame, count: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``table`` (one row per key, ``count`` the rows that hold
    it): inner or left_semi. The at most 1,000 hot keys are broadcast, so that
    their rows stay where they are; the others are shuffled."""
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = table.where(F.col(count) > total * HOT_SHARE)
    cold = table.where(F.col(count) <= total * HOT_SHARE).drop(count)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot.drop(count)), keys, how).unionByName(rest.join(cold, keys, how))
