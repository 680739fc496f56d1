"""Registered queries against their oracle SQL (DuckDB) on the smallest tables,
plus the flagship entry point."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql as all_sql, queries as all_queries
from postclust.plans.catalog import QUERIES
from postclust.plans.oracle import oracle_sql

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i]) for i in order))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


SQL_TYPES = {"integer": "INTEGER", "long": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def test_every_query_has_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(all_queries()) and set(oracle_sql()) <= set(all_sql()) <= set(all_queries())


def test_bernoulli_sample_query(spark, sf_small):
    from postclust.plans.catalog import WIDE, _vectors

    df = QUERIES["q_sample_bernoulli"](spark, sf_small)
    n = _vectors(spark, sf_small, WIDE).count()
    assert df.columns == ["question_id", "x", "y"]
    assert 0 < df.count() < 0.3 * n


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    res = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(res.fetchall(), dcols)
    rel = duck.sql(oracle_sql()[name])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: SQL_TYPES.get(f.dataType.typeName(), f.dataType.typeName()) for f in df.schema.fields}
    assert spark_types == duck_types


def test_entry(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["cid", "lang", "pct", "size", "median_score"]
    assert [r["median_score"] for r in rows] == sorted(r["median_score"] for r in rows)
