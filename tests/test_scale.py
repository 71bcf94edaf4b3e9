"""What goes through the shuffles of a store and into its files."""

from __future__ import annotations

import re
import shutil

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from evalspark.functions.maps import empty_string_map
from evalspark.operators.task_eval import measurement_tags
from evalspark.sources import store as ST
from evalspark.sources.shards import read_shards
from fixtures import VALID_ENVELOPE
from test_store import envelopes

STAMP = "2025-03-14T15:09:26Z"


def test_digests_are_bytes_in_shuffles_and_come_out_as_they_were(spark):
    digests = ["0" * 64, "ab" * 32, "AB" * 32, "ab" * 31, "ab" * 32 + "\n", "abc", "", None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(digests)], "i int, content_sha string")
    there = ST.packed(rows)
    assert [r.i for r in there.where("_sha IS NOT NULL").orderBy("i").collect()] == [0, 1]
    assert there.where("_sha IS NOT NULL AND content_sha IS NOT NULL").count() == 0
    assert [r.content_sha for r in ST.unpacked(there).orderBy("i").collect()] == digests
    assert ST.packed(rows.select("i")).columns == ["i"]


def test_an_append_shuffles_runs_and_not_their_rows(spark, tmp_path):
    runs = envelopes(spark, *[VALID_ENVELOPE.replace(STAMP, f"2025-03-14T15:09:{s:02}Z") for s in (1, 2, 2)])
    want = ST.publishable_rows(runs.limit(2)).drop("raw")
    balanced = ST.balanced_rows(ST.packed(ST.with_shard_key(runs)))
    plan = balanced._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"(?s)Generate explode.*Rebalance", plan)
    path = str(tmp_path / "store")
    ST.append_new(runs, path, "a")
    stored = read_shards(spark, path).select("shard_key", "content_sha", "name", "metric", "value", "timestamp")
    assert sorted(map(str, stored.collect())) == sorted(map(str, want.select(*stored.columns).collect()))
    assert stored.count() == want.count() > 0
    for folder in ("store", "store_keys"):
        for file in (tmp_path / folder).rglob("*.parquet"):
            assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD", file


def test_the_key_of_a_measurement_yields_to_stated_tags(spark):
    tags = F.when(F.col("id") == 0, F.create_map(F.lit("a"), F.lit("1"))).when(F.col("id") == 1, F.create_map(F.lit("lm_eval_key"), F.lit("mine")))
    tags = tags.when(F.col("id") == 2, empty_string_map())
    got = spark.range(4).select(measurement_tags(F.lit("k"), tags).alias("t")).collect()
    assert [r.t for r in got] == [{"lm_eval_key": "k", "a": "1"}, {"lm_eval_key": "mine"}, {"lm_eval_key": "k"}, None]


def wide_shuffles(spark, monkeypatch, work):
    """What ``work`` writes as rows, and how many of those writes deal rows to files by a shuffle."""
    plans = []
    real = ST._write

    def noted(rows, path, partition_by=()):
        plans.append((path, rows._jdf.queryExecution().optimizedPlan().toString()))
        real(rows, path, partition_by)

    monkeypatch.setattr(ST, "_write", noted)
    work()
    monkeypatch.setattr(ST, "_write", real)
    return [(path, "Rebalance" in plan, "Join" in plan) for path, plan in plans]


def numbered(spark, n, suite="reasoning"):
    runs = envelopes(spark, *[VALID_ENVELOPE.replace("0.375", str(i + 0.5)) for i in range(n)])
    return runs.withColumn("suite", F.lit(suite))


def test_a_batch_of_one_suite_is_not_dealt_by_suite(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    both = numbered(spark, 3).unionByName(numbered(spark, 2, "coding"))
    ST.start(spark, path)
    ST.write_rows(ST.publishable_rows(both), path, "again")  # a lost driver left rows of two suites under the name
    found = wide_shuffles(spark, monkeypatch, lambda: ST.append_new(numbered(spark, 3), path, "again"))
    assert found and not [p for p, dealt, _ in found if dealt]
    assert sorted(r["value"] for r in read_shards(spark, path).collect()) == [0.5, 1.5, 2.5]
    found = wide_shuffles(spark, monkeypatch, lambda: ST.append_new(both, path))  # what is stored already is left out
    assert sorted((r["suite"], r["value"]) for r in read_shards(spark, path).collect()) == [("coding", 0.5), ("coding", 1.5)] + [
        ("reasoning", i + 0.5) for i in range(3)
    ]
    assert ST.read_keys(spark, path).count() == 5


def test_a_merge_shuffles_no_rows_of_large_suites(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "LARGE_SUITE", 3)
    path = str(tmp_path / "store")
    ST.append_new(numbered(spark, 4), path, "a")
    ST.append_new(numbered(spark, 4, "coding"), path, "b")
    ST.write_results(ST.publishable_rows(numbered(spark, 4).unionByName(numbered(spark, 1, "knowledge"))), path, "c")  # all but one are in a
    ST.write_results(ST.publishable_rows(numbered(spark, 3, "coding")), path, "d")  # all are in b
    found = wide_shuffles(spark, monkeypatch, lambda: ST.merge(spark, path, ["d", "c", "b", "a"], 1))
    large = [f for f in found if "/suite=" in f[0]]
    assert len(large) == 4 and not [f for f in large if f[1]]
    stored = read_shards(spark, path)
    assert sorted((r["suite"], r["value"]) for r in stored.collect()) == [("coding", i + 0.5) for i in range(4)] + [("knowledge", 0.5)] + [
        ("reasoning", i + 0.5) for i in range(4)
    ]
    keys = ST.read_keys(spark, path)
    assert keys.count() == 9 and keys.agg(F.sum("n_rows")).first()[0] == 9 and keys.join(stored, ["content_sha", "shard_key", "suite"]).count() == 9
    assert not [f for f in stored.inputFiles() if "merged-" not in f]


def test_a_merge_of_parts_that_share_nothing_joins_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    for name in ("reasoning", "coding"):
        ST.append_new(numbered(spark, 2, name), path, name)
    found = wide_shuffles(spark, monkeypatch, lambda: ST.merge(spark, path, ["coding", "reasoning"], 1))
    assert not [f for f in found if f[2]]
    assert sorted(r["value"] for r in read_shards(spark, path).collect()) == [0.5, 0.5, 1.5, 1.5]


def test_a_merge_keeps_rows_whose_keys_are_gone(spark, tmp_path):
    path = str(tmp_path / "store")
    ST.append_new(numbered(spark, 2), path, "a")
    ST.write_results(ST.publishable_rows(numbered(spark, 4)), path, "b")
    shutil.rmtree(path + "_keys/batch_id=b")
    ST.merge(spark, path, ["a", "b"], 1)
    assert sorted(r["value"] for r in read_shards(spark, path).collect()) == [0.5, 1.5, 2.5, 3.5]
    assert ST.read_keys(spark, path).count() == 4
