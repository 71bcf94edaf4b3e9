from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from evalspark.functions import variants as V
from evalspark.operators import convert as C
from evalspark.operators import task_eval as T
from evalspark.operators import validate as VA
from evalspark.operators.flatten import flatten, tag_keys, tags_to_columns
from evalspark.sources.raw import parse_documents, read_raw
from fixtures import MODEL, SERVING_DOCUMENT, TASK, TASK_DOCUMENT

SYSTEM = "named_struct('os', 'o', 'chip', 'c', 'memory_gb', 8L)"


def context(df):
    return (
        df.withColumn("suite", F.lit("reasoning"))
        .withColumn("git_sha", F.lit("deadbeef"))
        .withColumn("system", F.expr(SYSTEM))
    )


def converted(spark, raws, kind="lm-eval", tags=None, ts="2026-01-02 03:04:05"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, raw string")
    df = context(parse_documents(df))
    if tags:
        df = df.withColumn("extra_tags", F.create_map(*[F.lit(x) for kv in tags.items() for x in kv]))
    return C.convert(C.fill_run_context(df), kind, ["id"], F.lit(ts).cast("timestamp"))


def one(spark, raw, **kw):
    return converted(spark, [raw], **kw).first().asDict(True)


def test_task_document_golden(spark):
    e = one(spark, TASK_DOCUMENT)
    assert e["problems"] == []
    assert e["timestamp"] == "2025-06-15T15:06:40Z"
    assert e["model"] == MODEL
    assert e["gen_kwargs"] == {"max_gen_toks": 2000, "temperature": 0.5, "top_p": None, "top_k": None}
    assert e["seed"] is None and e["model_revision"] is None and e["errors"] == [] and e["trigger"] == "local"
    shared = {"total_eval_time_s": "61.75", "n_limit": "16", "max_gen_toks": "2000"}
    got = {r["metric"]: r for r in e["results"]}
    assert set(got) == {"exact_match_flexible", "exact_match_strict"}
    assert got["exact_match_flexible"]["value"] == 0.375 and got["exact_match_strict"]["value"] == 0.25
    assert got["exact_match_flexible"]["tags"] == {"lm_eval_key": "exact_match,flexible-extract", **shared}
    assert all(r["unit"] == "ratio" and r["duration_seconds"] is None for r in e["results"])


def test_converted_documents_are_valid(spark):
    for raw, kind in ((TASK_DOCUMENT, "lm-eval"), (SERVING_DOCUMENT, "vllm")):
        done = converted(spark, [raw], kind=kind)
        checked = VA.with_violations(done.withColumn("doc", VA.envelope_variant(done)))
        assert checked.first()["violations"] == []


def test_serving_document_golden(spark):
    e = one(spark, SERVING_DOCUMENT, kind="vllm", tags={"input_len": "256", "completed_requests": "0"})
    got = {r["metric"]: (r["value"], r["unit"]) for r in e["results"]}
    assert got == {
        "throughput_output_toks_per_s": (640.0, "tok/s"),
        "throughput_total_toks_per_s": (1040.0, "tok/s"),
        "throughput_requests_per_s": (3.25, "req/s"),
        "ttft_p50_ms": (10.0, "ms"),
        "ttft_p99_ms": (30.0, "ms"),
        "tpot_p50_ms": (20.0, "ms"),
        "tpot_p99_ms": (60.0, "ms"),
        "itl_p50_ms": (30.0, "ms"),
        "itl_p99_ms": (90.0, "ms"),
    }
    tags = {
        "input_len": "256",
        "completed_requests": "40",
        "total_input_tokens": "5000",
        "total_output_tokens": "8000",
    }
    assert all(r["name"] == "benchmark_serving" and r["duration_seconds"] == 12.5 and r["tags"] == tags for r in e["results"])
    assert e["timestamp"] == "2026-01-02T03:04:05Z" and e["gen_kwargs"] is None


def test_serving_document_with_few_keys(spark):
    e = one(spark, '{"output_throughput": 1, "median_ttft_ms": 2, "p99_ttft_ms": 3}', kind="vllm")
    assert {r["metric"] for r in e["results"]} == {"throughput_output_toks_per_s", "ttft_p50_ms", "ttft_p99_ms"}
    assert all(r["duration_seconds"] is None and r["tags"] == {} for r in e["results"])


def test_which_values_are_measurements(spark):
    raw = """{"results": {"t": {"s": "0.5", "n": null, "b": true, "i": 3, "x,y,z": 1e2, "acc_stderr,none": 1,
              "alias": 7, "l": [1], "wait_ms": 1, "load_seconds": 2, "acc,none": 0.25}}}"""
    got = {r["metric"]: (r["value"], r["unit"]) for r in one(spark, raw)["results"]}
    assert got == {
        "b": (1.0, "ratio"),
        "i": (3.0, "ratio"),
        "x_y_z": (100.0, "ratio"),
        "wait_ms": (1.0, "ms"),
        "load_seconds": (2.0, "seconds"),
        "accuracy": (0.25, "ratio"),
    }


def test_no_measurements_is_an_envelope(spark):
    raws = ["{}", '{"results": null}', '{"results": {}}', '{"results": {"t": {}}}', '{"results": []}']
    for e in converted(spark, raws).collect():
        assert e["results"] == [] and e["problems"] == [] and e["model"] == "unknown"


def test_unreadable_documents_are_named(spark):
    raws = [
        "{this is not json",
        '{"results": {"t": {"m": NaN}',
        "[1]",
        '{"config": "text"}',
        '{"config": {"model_args": "a=b"}}',
        '{"results": {"t": 5}}',
        '{"date": 1e30}',
        '{"config": {"seed": true}}',
        '{"config": {"seed": 18446744073709551615}}',
    ]
    rejects = C.split_converted(converted(spark, raws), ["id"])[1]
    assert {r["id"]: r["reason"] for r in rejects.collect()} == {
        0: "not valid JSON",
        1: "not valid JSON",
        2: "document is not an object",
        3: "config is not an object",
        4: "config.model_args is not an object",
        5: "metrics are not an object: t",
        6: "date is out of range",
        7: "config.seed is a boolean",
        8: "config.seed does not fit 64 bits",
    }


DATES = [
    ("1766640000", "2025-12-25T05:20:00Z"),
    ("1766640000.9", "2025-12-25T05:20:00Z"),
    ("1.9999999", "1970-01-01T00:00:02Z"),
    ("true", "1970-01-01T00:00:01Z"),
    ('"2024-05-06T07:08:09Z"', "2024-05-06T07:08:09Z"),
    ('"2024-05-06T07:08:09.123Z"', "2024-05-06T07:08:09.123Z"),
    ('"2024-05-06 07:08:09"', "2026-01-02T03:04:05Z"),
    ("null", "2026-01-02T03:04:05Z"),
]


def test_timestamp(spark):
    rows = converted(spark, ['{"date": %s}' % date for date, _ in DATES]).orderBy("id").collect()
    assert [r["timestamp"] for r in rows] == [expected for _, expected in DATES]


def test_seed_revision_and_settings(spark):
    e = one(spark, '{"config": {"seed": 7, "model_args": {"revision": "r1"}, "gen_kwargs": {"max_gen_toks": 4096.0, "top_p": 1}}}')
    assert e["seed"] == 7 and e["model_revision"] == "r1"
    assert e["gen_kwargs"] == {"max_gen_toks": None, "temperature": None, "top_p": 1.0, "top_k": None}
    e = one(spark, '{"model_source": 12, "config": {"seed": 7.0, "model_args": {"revision": "r1"}, "gen_kwargs": {"x": 1}}}')
    assert e["seed"] is None and e["model_revision"] == "12" and e["gen_kwargs"] is None


def test_document_overrides_tags_of_the_caller(spark):
    raw = '{"results": {"t": {"m": 1}}, "config": {"limit": 100.0}, "total_evaluation_time_seconds_per_task": {"t": 0}}'
    r = one(spark, raw, tags={"n_limit": "1", "lm_eval_key": "mine", "team": "a"})["results"][0]
    assert r["tags"] == {"n_limit": "100.0", "lm_eval_key": "mine", "team": "a"}
    assert r["duration_seconds"] == 0.0


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="no converter for 'no-such-tool'"):
        converted(spark, ["{}"], kind="no-such-tool")


def test_unknown_system_field(spark):
    df = spark.sql("SELECT named_struct('os', 'o', 'gpu', 'g') AS system")
    with pytest.raises(ValueError, match="gpu"):
        C.fill_run_context(df)


def test_defaults_of_the_run_context(spark):
    row = C.fill_run_context(spark.range(1)).first()
    assert row["trigger"] == "local" and row["git_sha"] == "unknown" and row["extra_tags"] == {}
    assert row["system"].asDict() == dict.fromkeys(row["system"].asDict())


def test_tag_pairs(spark):
    df = spark.createDataFrame(
        [(1, ["a=1", "b=x=y", "a=2", "c="]), (2, ["no-equals-sign", "k=v"]), (3, ["=v"]), (4, None)], "id int, pairs array<string>"
    )
    good, bad = C.parse_tag_pairs(df, "pairs", ["id"])
    assert {r["id"]: r["tags"] for r in good.collect()} == {1: {"a": "2", "b": "x=y", "c": ""}, 4: {}}
    assert {(r["id"], r["pair"]) for r in bad.collect()} == {(2, "no-equals-sign"), (3, "=v")}


def test_read_raw_one_document_per_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(TASK_DOCUMENT)
    (tmp_path / "b.json").write_text("{this is not json")
    docs, rejects = read_raw(spark, str(tmp_path))
    assert docs.count() == 1 and docs.first()["path"].endswith("a.json")
    bad = rejects.collect()
    assert len(bad) == 1 and bad[0]["path"].endswith("b.json") and bad[0]["reason"] == "not valid JSON"


def test_tags_to_columns_takes_the_union_of_keys(spark):
    df = spark.sql("SELECT 1 AS id, map('a', 'x') AS tags UNION ALL SELECT 2, map('b', 'y')")
    assert tag_keys(df) == ["a", "b"]
    rows = {r["id"]: (r["tag_a"], r["tag_b"]) for r in tags_to_columns(df).collect()}
    assert rows == {1: ("x", None), 2: (None, "y")}


def test_flat_row_of_an_envelope(spark):
    row = flatten(converted(spark, [TASK_DOCUMENT]), ["id"]).where("metric = 'exact_match_strict'").first()
    assert (row["os"], row["chip"], row["memory_gb"], row["suite"], row["value"]) == ("o", "c", 8, "reasoning", 0.25)


def test_float_text_equals_shortest_text(spark):
    rng = random.Random(1)
    values = [0.0, 1.0, 100.0, -0.5, 1e-4, 1e-5, 1.5e-7, 1e7, 123456789.0, 1.25e10, 1e15, 1e16, 1.5e16, 1e22, 1.7e308, 5e-324]
    values += [rng.uniform(-1e6, 1e6) for _ in range(300)]
    values += [round(rng.uniform(0, 10 ** rng.randint(-6, 18)), rng.randint(0, 8)) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wrong = []
    for r in df.select("v", V.float_text(F.col("v")).alias("t")).collect():
        # The JVM may print one digit more than needed; the number it stands for is the same.
        if r["t"] != repr(r["v"]) and not (float(r["t"]) == r["v"] and len(r["t"]) > len(repr(r["v"]))):
            wrong.append((r["v"], r["t"]))
    assert wrong == []


def test_truthiness(spark):
    texts = ['""', "0", "0.0", "null", "false", "[]", "{}", '"a"', "1", "true", "[0]", '{"a":0}', "[null]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("v", F.parse_json("t"))
    got = [r["b"] for r in df.select("i", V.truthy(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == [False] * 7 + [True] * 6


def test_explode_equals_in_row_form(spark):
    df = parse_documents(spark.createDataFrame([(1, TASK_DOCUMENT)], "id int, raw string"))
    rows = T.explode_task_metrics(df).where(T.is_measurement(F.col("metric_key"), F.col("metric_value"))).collect()
    assert {(r["task"], r["metric_key"]) for r in rows} == {
        (TASK, "exact_match,flexible-extract"),
        (TASK, "exact_match,strict-match"),
    }


def test_what_common_tools_write_beyond_strict_json(spark):
    e = one(spark, '{"model_name": "a", "model_name": "b", "results": {"t": {"acc,none": 0.5, "acc_stderr,none": NaN, "x": Infinity, "y": NaN}}}')
    got = {r["metric"]: r["value"] for r in e["results"]}
    assert e["model"] == "b" and e["problems"] == [] and set(got) == {"accuracy", "x", "y"}
    assert got["accuracy"] == 0.5 and got["x"] == math.inf and math.isnan(got["y"])


def test_only_wanted_columns_are_made(spark):
    df = context(parse_documents(spark.createDataFrame([(0, TASK_DOCUMENT)], "id int, raw string")))
    done = C.convert(C.fill_run_context(df), "lm-eval", ["id"], F.lit("2026-01-01").cast("timestamp"), ["model", "results"], with_tags=False)
    assert done.columns == ["id", "problems", "model", "results"]
    text = flatten(C.split_converted(done, ["id"])[0], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert not any(word in text for word in ("map_concat", "memory_snapshots", "quantization", "model_revision"))
    assert flatten(done, ["id"]).first()["value"] in (0.25, 0.375)


def test_double_bits_are_kept(spark):
    raw = '{"results": {"t": {"a": 0.1, "b": 1e-320, "c": 123456789012345678901234567890}}}'
    got = {r["metric"]: r["value"] for r in one(spark, raw)["results"]}
    want = {"a": 0.1, "b": 1e-320, "c": 1.2345678901234568e29}
    assert {k: struct.pack("d", v) for k, v in got.items()} == {k: struct.pack("d", v) for k, v in want.items()}
    assert not any(math.isnan(v) for v in got.values())
