"""The pipeline against plain Python, stage by stage."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from evalspark.llm import catalog

from .test_decontaminate import brute_force
from .test_similarity import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_agree_with_plain_python(spark, sf_dir, documents):
    rows = [tuple(r) for r in documents.collect()]
    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    kept = [r for r, (doc_id, _, least) in zip(kept, brute_components([r[:2] for r in kept]), strict=True) if doc_id == least]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    dirty = {d for d, _, n, _ in brute_force([r[:2] for r in kept], items) if n}
    kept = [r for r in kept if r[0] not in dirty]
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == [*COLUMNS, "vslot", "shard"]
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == sorted(kept)
    assert 0 < len(kept) < len(rows) and dirty


def test_mixing_orders_the_rows(spark, sf_dir, documents):
    mixed = corpus_pipeline.mix(spark, documents, sf_dir)
    assert Counter(map(tuple, mixed.collect())) == Counter(map(tuple, documents.collect()))
    first = [r.source for r in mixed.limit(20 * 8).collect()]
    assert len(set(first)) == 20  # equal sources: one block of each in turn


def test_shards_keep_the_mixed_order(spark, sf_dir):
    got = [(r.shard, r.doc_id) for r in corpus_pipeline.run(spark, sf_dir).collect()]
    kept = corpus_pipeline.run(spark, sf_dir).drop("vslot", "shard").orderBy("doc_id")
    mixed = {r.doc_id: n for n, r in enumerate(corpus_pipeline.mix(spark, kept, sf_dir).collect())}
    assert got == sorted(got, key=lambda r: (r[0], mixed[r[1]])) and len(got) == len(mixed) > 100


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_pass(spark, sf_dir, odd, frame, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, frame([]), sf_dir).count() == 0
    out = stage(spark, odd, sf_dir)
    rows = Counter((r.doc_id, r.text) for r in out.collect())
    whole = Counter((r.doc_id, r.text) for r in odd.select("doc_id", "text").collect())
    gone = {"language_id": {1, 2, 4}, "near_duplicates": {2}}.get(name, set())
    want = Counter({k: 1 if name == "near_duplicates" else n for k, n in whole.items() if k[0] not in gone})
    assert rows == want
    assert set(odd.columns) <= set(out.columns)
    assert name == "sharding" or out.columns == odd.columns


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_queries_without_sql_run(spark, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    assert df.count() > 0 or name == "pipeline"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, sf_dir)
    cursor = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in cursor.fetchall())
    assert sorted(repr([r[c] for c in sorted(df.columns)]) for r in df.collect()) == want
