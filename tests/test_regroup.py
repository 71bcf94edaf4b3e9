"""Stored measurements back to envelopes."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark.operators import validate as VA
from evalspark.operators.parts import in_parts, numbered_within
from evalspark.operators.regroup import regroup
from evalspark.schemas import ENVELOPE_COLUMNS
from evalspark.sources import store as ST
from evalspark.sources.raw import parse_documents
from evalspark.sources.shards import read_shards
from fixtures import VALID_ENVELOPE
from test_store import envelopes

STAMP = "2025-03-14T15:09:26Z"


def test_flatten_store_regroup(spark, tmp_path):
    times = [STAMP, "2025-03-14T15:09:26.5Z", "2025-03-14t15:09:26.123456z", "2025-03-14T17:09:26+02:00", "2025-03-14T15:09:26-00:30"]
    item = '{"name": "n%d", "metric": "m", "value": %d.25, "unit": "u", "tags": {"b": "%d", "a": "x"}, "raw": {"k": 1}}'
    many = ", ".join(item % (i % 7, i, i % 3) for i in range(250))
    raws = [VALID_ENVELOPE.replace(STAMP, t) for t in times]
    raws.append(VALID_ENVELOPE[: VALID_ENVELOPE.index('"results"')] + f'"results": [{many}], "errors": []}}')
    runs = envelopes(spark, *raws)
    want = {r["content_sha"]: r["payload"] for r in ST.with_shard_key(runs).collect()}
    path = str(tmp_path / "store")
    ST.append_new(runs, path)
    stored = read_shards(spark, path)
    back = regroup(stored)
    got = back.withColumn("payload", ST.canonical_payload()).collect()
    assert {r["content_sha"]: r["payload"] for r in got} == want and all(r["verified"] for r in got)
    assert {r["timestamp"] for r in got} == set(times)
    # An envelope again: valid, and with the same key when it is stored once more.
    assert set(ENVELOPE_COLUMNS) <= set(back.columns)
    ST.append_new(back, path)
    assert read_shards(spark, path).count() == stored.count()
    texts = back.select("shard_key", F.to_json(F.struct(*[c for c in ENVELOPE_COLUMNS if c != "gen_kwargs"])).alias("raw"))
    assert VA.typed_envelopes(parse_documents(texts), ["shard_key"]).count() == len(raws)

    # A run with more measurements than an envelope is to hold comes back in ordered parts.
    cut = regroup(stored, most=100).orderBy("part").collect()
    long = [r for r in cut if r["n_results"] > 1]
    assert [r["n_results"] for r in long] == [100, 100, 50] and [r["verified"] for r in long] == [None] * 3
    (whole,) = [r for r in got if r["n_results"] == 250]
    assert [x for r in long for x in r["results"]] == whole["results"]
    changed = regroup(stored.withColumn("value", F.col("value") + 1))
    assert {r["verified"] for r in changed.collect()} == {False}


def test_numbers_within_a_hot_key(spark):
    rows = spark.range(5_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 4).alias("k"), F.xxhash64("id").alias("v"), "id")
    got = numbered_within(rows, ["k"], ["v", "id"], "n").collect()
    by_key = {}
    for r in sorted(got, key=lambda r: (r["v"], r["id"])):
        assert r["n"] == by_key.get(r["k"], 0)
        by_key[r["k"]] = r["n"] + 1
    assert sum(by_key.values()) == 5_000 and len(by_key) == 5
    assert in_parts(rows, ["k"], ["v"], 10_000).agg(F.max("part")).first()[0] == 0
    sizes = [r["count"] for r in in_parts(rows, ["k"], ["v", "id"], 700).groupBy("k", "part").count().collect()]
    assert max(sizes) == 700 and sum(sizes) == 5_000
