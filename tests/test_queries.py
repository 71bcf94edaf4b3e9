"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_point

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = entry_point.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    cursor = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(repr([r[names.index(c)] for c in columns]) for r in cursor.fetchall())
    assert got == want


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["model", "label", "value"] and df.count() > 0
