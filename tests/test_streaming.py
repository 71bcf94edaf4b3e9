from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import functions as F

from evalspark.operators import results as Q
from evalspark.operators.publish import publish
from evalspark.schemas import flat_schema
from evalspark.sources import store as ST
from evalspark.sources.shards import read_shards, with_derived
from evalspark.streaming import convert as SC
from evalspark.streaming import results as SR
from fixtures import SERVING_DOCUMENT, TASK_DOCUMENT


def flat(spark, n):
    """Few keys, one of them hot, late and missing times, missing values, equal times."""
    return spark.range(n).select(
        F.lit("1").alias("schema_version"),
        F.when(F.col("id") % 50 != 7, F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.col("id") * 7919, F.lit(500)))).alias("timestamp"),
        F.lit("abcdef0").alias("git_sha"),
        F.lit("local").alias("trigger"),
        F.lit("reasoning").alias("suite"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), (F.col("id") % 5).cast("string"))).alias("model"),
        *[F.lit(None).cast("string").alias(c) for c in ("os", "chip")],
        F.lit(None).cast("bigint").alias("memory_gb"),
        *[F.lit(None).cast("string").alias(c) for c in ("model_revision", "quantization")],
        F.lit(None).cast("bigint").alias("seed"),
        F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("name"),
        F.lit("accuracy").alias("metric"),
        F.when(F.col("id") % 4 != 1, F.col("id").cast("double")).alias("value"),
        F.lit("ratio").alias("unit"),
        F.lit(None).cast("double").alias("duration_seconds"),
        F.expr("map('k', CAST(id AS STRING))").alias("tags"),
        F.format_string("shard-%06d", "id").alias("shard_key"),
        F.sha2(F.col("id").cast("string"), 256).alias("content_sha"),
    )


def test_maintained_latest_equals_batch(spark, tmp_path):
    shards, state = str(tmp_path / "shards"), str(tmp_path / "state")
    rows = flat(spark, 600)

    def run():
        stream = SR.stream_results(spark, shards, flat_schema(), maxFilesPerTrigger="1")
        SR.start_latest(stream, state, state + "-checkpoint", once=True).awaitTermination()
        return {tuple(r) for r in SR.read_latest(spark, state).collect()}

    def batch():
        newest = Q.latest(with_derived(spark.read.parquet(shards)), SR.LATEST_KEYS)
        return {tuple(r) for r in newest.select(*SR.LATEST_KEYS, "value", "timestamp").collect()}

    # Four arrivals in two starts of the stream, the last one of rows that were there before.
    parts = rows.randomSplit([1.0, 1.0, 1.0], seed=5)
    parts[0].coalesce(1).write.mode("append").parquet(shards)
    parts[1].coalesce(1).write.mode("append").parquet(shards)
    assert run() == batch()
    parts[2].coalesce(1).write.mode("append").parquet(shards)
    parts[0].coalesce(1).write.mode("append").parquet(shards)
    SR.snapshot_latest(spark, state)
    SR.snapshot_latest(spark, state)
    assert run() == batch()
    SR.snapshot_latest(spark, state)
    assert {tuple(r) for r in SR.read_latest(spark, state).collect()} == batch()


def context(docs):
    return docs.withColumns(
        {
            "kind": F.when(F.col("raw").contains('"duration"'), "vllm").otherwise("lm-eval"),
            "git_sha": F.left(F.sha1("raw"), F.lit(16)),
            "suite": F.lit("reasoning"),
            "system": F.expr("named_struct('os', 'o', 'chip', 'c', 'memory_gb', 8L)"),
        }
    )


def test_documents_become_rows_once(spark, tmp_path):
    raw, out, rejects, checkpoint = (str(tmp_path / n) for n in ("raw", "out", "rejects", "checkpoint"))
    Path(raw).mkdir()

    def put(name, text):
        (Path(raw) / name).write_text(text)

    def run():
        stream = SC.stream_raw(spark, raw, maxFilesPerTrigger="2")
        ts = F.lit("2026-01-01").cast("timestamp")
        SC.start_convert(stream, F.col("kind"), ["path"], out, rejects, checkpoint, context, ts, once=True).awaitTermination()
        bad = spark.read.parquet(rejects)
        return read_shards(spark, out), {Path(r["path"]).name: r["reasons"] for r in bad.collect()}

    put("a.json", TASK_DOCUMENT)
    put("b.json", SERVING_DOCUMENT)
    put("c.json", "{this is not json")
    put("d.json", json.dumps({"results": {}}))
    put("e.json", TASK_DOCUMENT)
    rows, bad = run()
    assert rows.count() == 2 + 9
    assert set(bad) == {"c.json", "d.json"} and bad["c.json"] == ["not valid JSON"] and bad["d.json"] == [ST.NO_ROWS]

    # The same content again, and something new: only the new run is added.
    put("f.json", TASK_DOCUMENT)
    put("g.json", TASK_DOCUMENT.replace("0.375", "0.75"))
    rows, bad = run()
    assert rows.count() == 2 + 9 + 2 and set(bad) == {"c.json", "d.json"}

    # A batch that is done again after a crash before its commit was noted overwrites itself.
    before = sorted(str(r) for r in rows.collect())
    commits = sorted((Path(checkpoint) / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    for crc in (Path(checkpoint) / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    rows, _ = run()
    assert sorted(str(r) for r in rows.collect()) == before


def test_streams_and_batches_share_a_store(spark, tmp_path):
    """Each writer's first batch has the number 0; none replaces what another has stored."""
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    ts = F.lit("2026-01-01").cast("timestamp")
    for n, value in enumerate(("0.1", "0.2", "0.3")):
        (tmp_path / f"raw{n}").mkdir()
        (tmp_path / f"raw{n}" / "a.json").write_text(TASK_DOCUMENT.replace("0.375", value))
        (tmp_path / f"raw{n}" / "b.json").write_text("{bad")
        stream = SC.stream_raw(spark, str(tmp_path / f"raw{n}"))
        SC.start_convert(stream, F.col("kind"), ["path"], out, rejects, str(tmp_path / f"checkpoint{n}"), context, ts, once=True).awaitTermination()
    docs = spark.createDataFrame([("x", TASK_DOCUMENT.replace("0.375", "0.4"))], "path string, raw string")
    publish(docs, F.col("kind"), ["path"], out, rejects, context, ts)
    stored = read_shards(spark, out).where("metric = 'exact_match_flexible'")
    assert sorted(r["value"] for r in stored.collect()) == [0.1, 0.2, 0.3, 0.4]
    assert spark.read.parquet(rejects).count() == 3


def test_batch_publishing(spark, tmp_path):
    raws = [TASK_DOCUMENT, SERVING_DOCUMENT, "{bad", "{}", TASK_DOCUMENT]
    docs = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, raw string")
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    args = (docs, F.col("kind"), ["id"], out, rejects, context, F.lit("2026-01-01").cast("timestamp"))
    planned = {tuple(r) for r in publish(*args, dry_run=True).collect()}
    assert {(i, n) for i, _, n, _ in planned} == {(0, 2), (1, 9), (4, 2)} and list(tmp_path.iterdir()) == []
    for _ in range(2):
        assert {tuple(r) for r in publish(*args).collect()} == planned
        assert read_shards(spark, out).count() == 2 + 9
    assert {r["id"] for r in spark.read.parquet(rejects).collect()} == {2, 3}


def test_without_validation_empty_runs_are_still_refused(spark, tmp_path):
    docs = spark.createDataFrame([(0, TASK_DOCUMENT), (1, "{}")], "id int, raw string")

    def no_context(df):
        return df.withColumn("suite", F.lit("no-such-suite"))

    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    publish(docs, "lm-eval", ["id"], out, rejects, no_context, validate=False)
    assert read_shards(spark, out).count() == 2
    assert [r["id"] for r in spark.read.parquet(rejects).collect()] == [1]


def test_invalid_envelopes_are_quarantined_with_all_reasons(spark, tmp_path):
    raw, out, rejects, checkpoint = (str(tmp_path / n) for n in ("raw", "out", "rejects", "checkpoint"))
    Path(raw).mkdir()
    (Path(raw) / "a.json").write_text(TASK_DOCUMENT)
    stream = SC.stream_raw(spark, raw)

    def no_context(docs):
        return docs.withColumn("suite", F.lit("no-such-suite"))

    SC.start_convert(stream, "lm-eval", ["path"], out, rejects, checkpoint, no_context, once=True).awaitTermination()
    reasons = spark.read.parquet(rejects).first()["reasons"]
    # No revision, no known suite, and the three required fields of a machine nobody probed.
    assert len(reasons) == 5 and any("$suite" in r for r in reasons) and any("chip (at $system)" in r for r in reasons)
    assert read_shards(spark, out).count() == 0
