from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from evalspark.functions.names import short_model, slugify
from evalspark.operators import validate as VA
from evalspark.schemas import flat_schema
from evalspark.sources import store as ST
from evalspark.sources.raw import parse_documents
from evalspark.sources.shards import read_shards
from fixtures import INVALID_ENVELOPE, MODEL, SLUG, VALID_ENVELOPE


def envelopes(spark, *raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, raw string")
    return VA.typed_envelopes(parse_documents(df), ["id"])


def test_names(spark):
    pairs = {
        MODEL: (SLUG, "Sparrow-2.5-Mini-6bit"),
        "openrouter/openai/heron-1": ("openrouter-openai-heron-1", "openrouter/heron-1"),
        "plain-name": ("plain-name", "plain-name"),
        "x/mlx-community/y": ("x-mlx-community-y", "x/mlx-community/y"),
        "mlx-community/openrouter/openai/z": ("mlx-community-openrouter-openai-z", "openrouter/z"),
        "_A  b_": ("a--b", "_A  b_"),
    }
    df = spark.createDataFrame([(m,) for m in pairs], "m string")
    got = df.select("m", slugify(F.col("m")), short_model(F.col("m"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == pairs


def test_key_without_and_with_payload(spark):
    df = envelopes(spark, VALID_ENVELOPE)
    bare, a, b = df.select(ST.shard_key(), ST.shard_key(F.lit("alpha")), ST.shard_key(F.lit("beta"))).first()
    stem = f"data/run-2025-03-14T15-09-26-5eed5eed-reasoning-{SLUG}"
    assert bare == stem + ".parquet"
    assert a == stem + "-8ed3f6ad.parquet"
    assert b.startswith(stem + "-") and b != a


def test_key_depends_on_content_not_on_order(spark):
    item = '{"name": "n", "metric": "%s", "value": %s, "unit": "u"}'
    base = VALID_ENVELOPE[: VALID_ENVELOPE.index('"results"')] + '"results": [%s, %s], "errors": []}'
    docs = [base % (item % ("a", 1), item % ("b", 2)), base % (item % ("b", 2), item % ("a", 1)), base % (item % ("a", 1), item % ("b", 3))]
    keys = [r["shard_key"] for r in ST.with_shard_key(envelopes(spark, *docs)).orderBy("id").collect()]
    assert keys[0] == keys[1] != keys[2]


def test_long_model_names_are_cut_after_trimming(spark):
    name = "-" + "a" * 49 + "/b"
    key = envelopes(spark, VALID_ENVELOPE.replace(MODEL, name)).select(ST.shard_key()).first()[0]
    assert key.endswith("-reasoning-" + "a" * 49 + "-.parquet")


def test_empty_runs_are_refused(spark):
    good, bad = ST.split_empty(envelopes(spark, VALID_ENVELOPE, INVALID_ENVELOPE), ["id"])
    assert [r["id"] for r in good.collect()] == [0]
    assert [(r["id"], r["reason"] == ST.NO_ROWS) for r in bad.collect()] == [(1, True)]


def test_plan_writes_nothing(spark, tmp_path):
    plan = ST.publish_plan(envelopes(spark, VALID_ENVELOPE), ["id"]).first()
    assert plan["n_rows"] == 1 and plan["payload_bytes"] > 100 and plan["shard_key"].startswith("data/run-")
    assert list(tmp_path.iterdir()) == []


def test_publishing_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    other = VALID_ENVELOPE.replace("0.375", "0.875")
    runs = envelopes(spark, VALID_ENVELOPE, VALID_ENVELOPE, other)
    ST.append_new(runs.where("id < 2"), path)
    assert read_shards(spark, path).count() == 1
    ST.append_new(runs, path)
    ST.append_new(runs, path)
    stored = read_shards(spark, path)
    assert sorted(r["value"] for r in stored.collect()) == [0.375, 0.875]
    assert stored.first()["model_short"] == "Sparrow-2.5-Mini-6bit"
    batches = sorted((tmp_path / "store").glob("batch_id=*"))
    assert len(batches) == 3 and sum((b / "suite=reasoning").is_dir() for b in batches) == 2


def test_shards_with_different_columns(spark, tmp_path):
    base = {"timestamp": ["2026-04-24T18:30:00Z"], "suite": ["s"], "name": ["n"], "metric": ["m"], "model": ["x"], "value": [1.0]}
    pq.write_table(pa.table(base), tmp_path / "a.parquet")
    # A column that was all NULL in its run: the writer gives it a type of its own.
    pq.write_table(pa.table({**base, "seed": pa.array([None], pa.int32())}), tmp_path / "b.parquet")
    pq.write_table(pa.table({"tag_k": ["v"], "seed": pa.array([7], pa.int64()), **base}), tmp_path / "c.parquet")
    got = read_shards(spark, str(tmp_path), flat_schema(tag_keys=["k"], timestamp_type="STRING"))
    assert sorted(str((r["seed"], r["tag_k"])) for r in got.collect()) == ["(7, 'v')", "(None, None)", "(None, None)"]
    assert got.schema["timestamp"].dataType.simpleString() == "timestamp"


def test_missing_dataset_is_empty(spark, tmp_path):
    got = read_shards(spark, str(tmp_path / "nothing"))
    assert got.count() == 0 and "model_short" in got.columns


def test_runs_whose_short_digests_are_equal_are_both_kept(spark, tmp_path):
    """Two contents that share the eight digits of the shard's name, found by search."""
    seen = {}
    for n in range(400_000):
        short = hashlib.sha256(f"content {n}".encode()).hexdigest()[:8]
        if short in seen:
            break
        seen[short] = n
    pair = [f"content {seen[short]}", f"content {n}"]
    both = envelopes(spark, VALID_ENVELOPE, VALID_ENVELOPE).withColumn("payload", F.get(F.array(*map(F.lit, pair)), F.col("id")))
    names = both.select(ST.shard_key(F.col("payload")).alias("k"), F.sha2("payload", 256).alias("d")).collect()
    assert len({r.k for r in names}) == 1 and len({r.d for r in names}) == 2
    keyed = both.withColumns({"content_sha": F.sha2("payload", 256), "shard_key": ST.shard_key(F.col("payload"))})
    monkey = ST.with_shard_key
    try:
        ST.with_shard_key = lambda df: df
        ST.append_new(keyed, str(tmp_path / "store"))
        ST.append_new(keyed, str(tmp_path / "store"))
    finally:
        ST.with_shard_key = monkey
    assert read_shards(spark, str(tmp_path / "store")).count() == 2


def test_odd_times_do_not_stop_a_batch(spark, tmp_path):
    stamp = "2025-03-14T15:09:26Z"
    times = [stamp, stamp.lower(), stamp.replace("Z", "+01:00"), "noon", "2025-02-30T00:00:00Z"]
    runs = envelopes(spark, *[VALID_ENVELOPE.replace(stamp, t) for t in times])
    good, bad = ST.split_empty(runs, ["id"])
    ST.append_new(good, str(tmp_path / "store"))
    assert {(r["id"], r["reason"]) for r in bad.collect()} == {(3, ST.NO_INSTANT), (4, ST.NO_INSTANT)}
    assert read_shards(spark, str(tmp_path / "store")).where("timestamp IS NOT NULL").count() == 3


def test_named_batches_replace_themselves_only(spark, tmp_path):
    path = str(tmp_path / "store")
    runs = envelopes(spark, *[VALID_ENVELOPE.replace("0.375", str(v)) for v in (1, 2, 3)])
    ST.append_new(runs.where("id = 0"), path, "a")
    ST.append_new(runs.where("id = 1"), path, "b")
    ST.append_new(runs.where("id IN (1, 2)"), path, "b")
    assert sorted(r["value"] for r in read_shards(spark, path).collect()) == [1, 2, 3]
    assert ST.read_keys(spark, path).count() == 3


def test_compaction_keeps_every_run_once(spark, tmp_path):
    path = str(tmp_path / "store")
    runs = envelopes(spark, *[VALID_ENVELOPE.replace("0.375", str(v)) for v in (1, 2, 3)])
    for batch in ("x", "y"):  # two publishers at once
        ST.write_results(ST.publishable_rows(runs), path, batch)
        ST.write_keys(spark, path, batch)
    assert read_shards(spark, path).count() == 6
    ST.compact(spark, path, path + "-new")
    assert sorted(r["value"] for r in read_shards(spark, path + "-new").collect()) == [1, 2, 3]
    ST.append_new(runs, path + "-new")
    assert read_shards(spark, path + "-new").count() == 3
