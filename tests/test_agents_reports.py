from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from evalspark.operators import agents as A
from evalspark.operators import reports as R

TRANSCRIPT = (
    "run_id int, step int, ts timestamp, role string, content string, "
    "tool_calls array<struct<tool: string, args: string>>, total_tokens bigint, completion_tokens bigint"
)


def transcript(spark, rows):
    timed = [(r, s, f"2026-01-01 00:00:{t:05.2f}", role, text, calls, total, completion) for r, s, t, role, text, calls, total, completion in rows]
    return spark.createDataFrame(timed, TRANSCRIPT.replace("timestamp", "string")).withColumn("ts", F.col("ts").cast("timestamp"))


CALL = [("file_read", '{"path": "/tmp/eval-test.txt"}')]
RUNS = [
    (1, 0, 0, "user", "q", None, None, None),
    (1, 1, 1.5, "assistant", "", CALL, 10, 3),
    (1, 1, 1.6, "tool", "text", None, None, None),
    (1, 2, 2.25, "assistant", "x" * 300, None, 0, 4),
    (1, 3, 9, "assistant", "late", None, 99, 99),
    (2, 0, 0, "user", "q", None, None, None),
    *[(2, i, i, "assistant", "more", CALL, 1, None) for i in range(1, 8)],
    (3, 0, 0, "user", "q", None, None, None),
    (3, 1, 4, "assistant", "", [], None, None),
]


def test_summaries(spark):
    got = {r["run_id"]: r for r in A.summarize_runs(transcript(spark, RUNS)).collect()}
    assert (got[1]["answer"], got[1]["steps"], got[1]["tokens"], got[1]["latency"]) == ("x" * 200, 2, 14, 2.25)
    assert (got[2]["answer"], got[2]["steps"], got[2]["tokens"], got[2]["latency"]) == ("(max steps reached)", 5, 5, 5.0)
    assert (got[3]["answer"], got[3]["steps"], got[3]["tokens"]) == ("(empty)", 1, 0)


def test_steps_from_calls_counts_repeated_reports_once(spark):
    twice = transcript(spark, RUNS + [(1, 1, 1.55, "assistant", "", CALL, 10, 3)])
    got = {r["run_id"]: (r["steps"], r["answer"]) for r in A.steps_from_calls(twice).collect()}
    assert got == {1: (2, "late"), 2: (8, "more"), 3: (1, "(empty)")}
    assert A.distinct_calls(A.tool_calls(twice).where("run_id = 1")).count() == 1


def test_call_lists_are_ordered(spark):
    calls = [("b", "1"), ("a", "2")]
    df = transcript(spark, [(1, 2, 2, "assistant", "", calls, 0, 0), (1, 1, 1, "assistant", "", [("z", "0")], 0, 0)])
    assert [c["tool"] for c in A.tool_call_lists(df).first()["tool_calls"]] == ["z", "b", "a"]


def test_call_lists_have_every_run_and_end_with_it(spark):
    many = [(f"t{i}", "{}") for i in range(2)]
    rows = [
        (1, 0, 0, "user", "q", None, None, None),
        (2, 1, 1, "assistant", "done", [], 0, 0),
        (2, 2, 2, "assistant", "", [("after", "{}")], 0, 0),
        *[(3, i, i, "assistant", "", [(f"s{i}", "{}")], 0, 0) for i in range(1, 12)],
        (4, 1, 1, "assistant", "", many[:1], 0, 0),
        (4, 1, 2, "assistant", "", many, 0, 0),
    ]
    got = {r["run_id"]: [c["tool"] for c in r["tool_calls"]] for r in A.tool_call_lists(transcript(spark, rows)).collect()}
    assert got == {1: [], 2: [], 3: [f"s{i}" for i in range(1, 12)], 4: ["t0", "t1"]}
    bounded = {r["run_id"]: len(r["tool_calls"]) for r in A.tool_call_lists(transcript(spark, rows), max_steps=5).collect()}
    assert bounded[3] == 5


def test_late_messages_do_not_stretch_a_run(spark):
    rows = [(9, 0, 0, "user", "q", None, None, None), *[(9, i, 2 * i, "assistant", "", CALL, 1, 1) for i in range(1, 7)], (9, 6, 50, "tool", "late", None, None, None)]
    (run,) = A.summarize_runs(transcript(spark, rows)).collect()
    assert (run["steps"], run["latency"]) == (5, 10.0)


def test_runs_as_envelopes(spark):
    df = spark.sql("SELECT 1 AS run_id, 'm/x' AS model, 'fw' AS framework, true AS passed, 2.5D AS latency, 10L AS input_tokens, 3L AS output_tokens, "
                   "timestamp'2026-01-01 10:00:00' AS ended")
    row = A.runs_to_envelopes(df).first()
    assert (row["model"], row["suite"], row["timestamp"]) == ("m/x", "framework-eval", "2026-01-01T10:00:00.000000Z")
    assert {r["metric"]: r["value"] for r in row["results"]} == {"score": 1.0, "latency": 2.5, "input_tokens": 10.0, "output_tokens": 3.0}


def test_reports_without_a_key(spark):
    df = spark.createDataFrame([("a", 0.5, True), ("b", 0.75, True), ("c", 0.9, False)], "model string, score double, valid boolean")
    assert {(r["model"], r["gap"]) for r in R.score_gap(df, [], "a").collect()} == {("a", 0.0), ("b", 0.25)}
    assert all(r["gap"] is None for r in R.score_gap(df, [], "nobody").collect())
    runs = spark.createDataFrame([("a", 10.0, 5), ("b", 10.0, 20)], "model string, total_seconds double, examples int")
    assert {(r["model"], r["speed_ratio"]) for r in R.per_example_cost(runs, [], "a").collect()} == {("a", 1.0), ("b", 4.0)}


def test_call_status(spark):
    ok, gone = "/tmp/eval-test.txt", "/tmp/gone.txt"
    cases = [
        ("file_read", '{"path": "%s"}' % ok, "ok"),
        ("file_read", '{"path": "%s"}' % gone, f"Error: File not found: {gone}"),
        ("file_read", '{"path": "/etc/passwd"}', "Error: path not allowed: /etc/passwd"),
        ("file_read", "{}", "Error: path not allowed: "),
        ("file_read", "{bad", "Error: malformed tool arguments"),
        ("other", "{bad", "Error: malformed tool arguments"),
        ("other", "{}", "Error: Unknown tool: other"),
        ("file_read", "[1]", "Error: tool arguments are not an object"),
    ]
    df = spark.createDataFrame([(i, t, a) for i, (t, a, _) in enumerate(cases)], "run_id int, tool string, args string")
    files = spark.createDataFrame([(ok,)], "path string")
    got = A.tool_call_status(df, files, allowed=[ok, gone]).orderBy("run_id").collect()
    assert [r["status"] for r in got] == [c[2] for c in cases]


def test_failures_are_answers(spark):
    df = spark.sql(
        "SELECT 1 AS run_id, 'a' AS answer, NULL AS error, timestamp'2026-01-01' AS started, timestamp'2026-01-01 00:00:01.255' AS ended "
        "UNION ALL SELECT 2, NULL, 'boom', timestamp'2026-01-01', timestamp'2026-01-01' "
        "UNION ALL SELECT 3, NULL, NULL, timestamp'2026-01-01', timestamp'2026-01-01'"
    )
    got = {r["run_id"]: r["answer"] for r in A.error_answers(df).collect()}
    assert got == {1: "a", 2: "Error: boom", 3: "(empty)"}


def test_runs_to_results(spark):
    df = spark.sql("SELECT 1 AS run_id, 'f' AS framework, true AS passed, 1.5D AS latency, CAST(NULL AS BIGINT) AS tokens")
    results = A.runs_to_results(df).first()["results"]
    assert [(r["name"], r["metric"], r["value"], r["unit"]) for r in results] == [("f", "score", 1.0, "bool"), ("f", "latency", 1.5, "sec")]


def test_exact_median_with_a_hot_key(spark):
    rng = random.Random(3)
    data = [("hot", rng.choice([rng.random(), 0.5])) for _ in range(50_000)]
    data += [("tied", 2.0)] * 1001 + [("one", 7.0)] + [("even", float(i)) for i in range(10)] + [("null", None), (None, 4.0), (None, 6.0)]
    got = {r["k"]: r["median"] for r in R.exact_median(spark.createDataFrame(data, "k string, v double").repartition(8), ["k"], "v").collect()}
    want = {k: statistics.median([v for kk, v in data if kk == k]) for k in ("hot", "tied", "one", "even")}
    assert got == {**want, "null": None, None: 5.0}


def test_exact_median_without_keys_and_with_a_sort_merge_join(spark):
    df = spark.range(100_001).select((F.col("id") * 7 % 100_001).cast("double").alias("v"), F.lit("a").alias("k")).repartition(8)
    assert R.exact_median(df, [], "v").first()["median"] == 50_000.0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert R.exact_median(df, ["k"], "v", {"n": F.count("v")}).first().asDict() == {"k": "a", "n": 100_001, "median": 50_000.0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_report_numbers(spark):
    arms = [(1, "direct", 59.92), (2, "direct", 44.07), (3, "direct", 65.74), (1, "via", 51.58), (2, "via", 35.25), (3, "via", 85.13)]
    df = spark.createDataFrame(arms, "sample int, arm string, seconds double").withColumn("correct", F.lit(True))
    summary = {r["arm"]: r for r in R.latency_summary(df, ["arm"]).collect()}
    assert round(summary["direct"]["mean"], 2) == 56.58 and round(summary["via"]["mean"], 2) == 57.32
    assert summary["via"]["median"] == 51.58 and summary["via"]["n_correct"] == 3
    gap = R.paired_overhead(df, [], "direct", "via").first()
    assert gap["n_pairs"] == 3 and round(gap["diff_of_means"], 2) == 0.74 and round(gap["paired_diff"], 2) == 0.74

    jobs = spark.createDataFrame([("d", 0.0, e) for e in (72.17, 72.49, 73.21, 73.98, 73.61)], "batch string, started double, ended double")
    speed = R.concurrency_speedup(jobs, ["batch"]).first()
    assert speed["wall"] == 73.98 and speed["speedup"] == pytest.approx(365.46 / 73.98)

    chunks = spark.createDataFrame([(1, 54.30 + 0.77 * i / 20) for i in range(21)], "request int, at double")
    timing = R.stream_timing(chunks, ["request"]).first()
    assert timing["chunks"] == 21 and round(timing["generation"], 2) == 0.77 and round(timing["rate"]) == 26

    runs = spark.createDataFrame(
        [("4bit", 5046.0, 100, 0.83, True), ("mxfp8", 16716.0, 100, 0.0, False), ("mxfp4", 4799.0, 100, 0.82, True)],
        "model string, total_seconds double, examples bigint, score double, valid boolean",
    ).withColumn("task", F.lit("gsm8k"))
    cost = {r["model"]: r for r in R.per_example_cost(runs, ["task"], "mxfp8").collect()}
    assert round(cost["mxfp4"]["per_example"]) == 48 and round(cost["mxfp4"]["speed_ratio"], 1) == 3.5
    gaps = {r["model"]: round(r["gap"], 2) for r in R.score_gap(runs, ["task"], "4bit").collect()}
    assert gaps == {"4bit": 0.0, "mxfp4": -0.01}
    budget = spark.createDataFrame([(4096, 25.0, 167.0, 0.0), (6000, 25.0, 200.0, 0.0), (9000, 25.0, 10.0, 0.5)], "max_gen_toks int, decode_rate double, per_example double, score double")
    flags = [(round(r["worst_per_example"]), r["budget_exhausted"], r["over_timeout"]) for r in R.budget_flag(budget).collect()]
    assert flags == [(164, True, False), (240, False, False), (360, False, True)]
    top = spark.createDataFrame([("a", 3), ("b", 9), ("c", None), ("d", 9)], "model string, downloads int")
    assert [r["model"] for r in R.top_models(top, 3).collect()] == ["b", "d", "a"]


def test_order_statistics_of_odd_values(spark):
    """Groups of every size, of values that are not all finite, against sorted lists; NaN comes after all others."""
    inf, nan = float("inf"), float("nan")
    rng = random.Random(2)
    odd = [nan, inf, -inf, None, 1.7976931348623157e308, -1.7976931348623157e308, 0.0, -0.0, 1e-320]
    groups = {f"g{n}": [rng.choice([*odd, rng.gauss(0, 1), rng.randrange(5)]) for _ in range(n)] for n in (0, 1, 2, 3, 5, 10, 11, 50, 101, 500, 3_000)}
    groups |= {"none": [None] * 4, "nan": [nan] * 7, "ties": [2.0] * 40 + [nan] * 20, "ends": [-inf, inf], "hot": [rng.random() for _ in range(20_000)] + [nan] * 9_000 + [-inf] * 3}
    df = spark.createDataFrame([(k, None if v is None else float(v)) for k, vs in groups.items() for v in vs], "k string, v double").repartition(8)
    at = {"low": 0.0, "p10": 0.1, "median": 0.5, "p77": 0.77, "p99": 0.99, "high": 1.0}

    def between(values, p):
        place = p * (len(values) - 1)
        lo, hi, part = values[int(place)], values[min(len(values) - 1, int(place) + (place > int(place)))], place - int(place)
        if part == 0 or lo == hi or (lo != lo and hi != hi):
            return lo
        straight = (lo + hi) / 2 if part == 0.5 else lo + (hi - lo) * part
        return straight if abs(straight) < inf else lo * (1 - part) + hi * part

    got = {r["k"]: r for r in R.exact_quantiles(df, ["k"], "v", at, {"n": F.count(F.lit(1))}).collect()}
    assert set(got) == {k for k, vs in groups.items() if vs}
    for k, r in got.items():
        values = sorted((float(v) for v in groups[k] if v is not None), key=lambda v: (v != v, v))
        for name, p in at.items():
            want = between(values, p) if values else None
            assert r[name] == want or (r[name] != r[name] and want != want) or abs(r[name] - want) <= 1e-12 * abs(want), (k, name, r[name], want)


def test_summaries_without_a_limit(spark):
    """Runs of any length: the plan does not grow with them, and turns after the final one do not count."""
    long = [(1, i, i / 100, "assistant", f"a{i}", CALL if i != 900 else [], 1, None) for i in range(1, 1_201)]
    rows = [*long, *[(2, i, i / 100, "assistant", "", CALL, 2, None) for i in range(1, 401)], (3, 0, 0, "user", "q", None, 9, None)]
    rows += [(4, 1, 5, "assistant", "one", None, 7, None), (4, 1, 6, "tool", "x", None, 100, None), (4, 2, 7, "assistant", "two", None, 7, None)]
    got = {r["run_id"]: (r["answer"], r["steps"], r["tokens"], r["latency"]) for r in A.summarize_runs(transcript(spark, rows), None).collect()}
    assert got == {1: ("a900", 900, 900, 8.99), 2: ("(empty)", 400, 800, 3.99), 3: ("(empty)", 0, 0, 0.0), 4: ("one", 1, 7, 0.0)}


def test_one_envelope_per_model_and_framework(spark):
    df = spark.sql(
        "SELECT id AS run_id, concat('m', id % 2) AS model, IF(id % 3 = 0, 'a', 'b') AS framework, id % 5 = 0 AS passed, id * 0.5D AS latency, "
        "IF(id % 4 = 0, NULL, id) AS tokens, timestamp_seconds(1700000000 - id) AS ended FROM range(60)"
    )
    whole = {(r["model"], r["framework"]): r for r in A.framework_envelopes(df).collect()}
    assert len(whole) == 4 and all(r["part"] == 0 for r in whole.values())
    parts = sorted(A.framework_envelopes(df, 4).collect(), key=lambda r: r["part"])
    for key, r in whole.items():
        runs = [x["tags"]["run_id"] for x in r["results"] if x["metric"] == "score"]
        assert [int(x) for x in runs] == sorted((i for i in range(60) if (f"m{i % 2}", "b" if i % 3 else "a") == key), reverse=True)
        cut = [p for p in parts if (p["model"], p["framework"]) == key]
        assert [p["part"] for p in cut] == list(range(-(-len(runs) // 4)))
        assert [x for p in cut for x in p["results"]] == r["results"]
        assert all(sum(x["metric"] == "score" for x in p["results"]) <= 4 for p in cut)
