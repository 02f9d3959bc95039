"""Every registered query with SQL against DuckDB on the smallest data, and the shape of the registry."""

from __future__ import annotations

import importlib.util
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def clean(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = ordered(tuple(clean(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == ordered(tuple(clean(r[i]) for i in at) for r in cursor.fetchall())


def test_registry():
    assert set(ORACLE) <= set(QUERIES)
    corpus = {n for n in QUERIES if n == "pipeline" or re.match(r"op\d+_", n)}
    spec = importlib.util.find_spec("riskmart.llm")
    assert bool(corpus) == (spec is not None and spec.origin is not None)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "default_rate_pct" in df.columns
