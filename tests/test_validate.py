from __future__ import annotations

import json

from pyspark.sql import functions as F

from evalspark.operators import validate as VA
from evalspark.operators.flatten import flatten, tags_to_columns
from evalspark.sources.raw import parse_documents
from fixtures import INVALID_ENVELOPE, VALID_ENVELOPE


def checked(spark, *raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, raw string")
    return VA.with_violations(parse_documents(df))


def found_all(spark, *raws):
    rows = checked(spark, *raws).orderBy("id").collect()
    return [[(".".join(v["path"]), v["keyword"]) for v in r["violations"]] for r in rows]


def found(spark, raw):
    return found_all(spark, raw)[0]


def changed(**members):
    doc = json.loads(VALID_ENVELOPE)
    doc.update(members)
    return json.dumps(doc)


def test_valid_envelope(spark):
    assert found(spark, VALID_ENVELOPE) == []


def test_invalid_envelope_reports_everything_in_path_order(spark):
    assert found(spark, INVALID_ENVELOPE) == [
        ("git_sha", "minLength"),
        ("git_sha", "pattern"),
        ("schema_version", "const"),
        ("suite", "enum"),
        ("system", "required"),
        ("timestamp", "format"),
        ("trigger", "enum"),
    ]


def test_bad_timestamp_is_scoped_to_its_path(spark):
    assert found(spark, changed(timestamp="not-an-iso-date")) == [("timestamp", "format")]


DATE_TIMES = [
    ("2026-04-24T18:30:00Z", True),
    ("2026-04-24t18:30:00z", True),
    ("2026-04-24T18:30:00.123456789+02:00", True),
    ("2024-02-29T00:00:00Z", True),
    ("2026-02-29T00:00:00Z", False),
    ("2026-04-31T00:00:00Z", False),
    ("2026-13-01T00:00:00Z", False),
    ("2026-04-24T24:00:00Z", False),
    ("2026-04-24T23:59:60Z", False),
    ("2026-04-24T18:30:00", False),
    ("2026-04-24 18:30:00Z", False),
    ("2026-04-24T18:30Z", False),
    ("0000-01-01T00:00:00Z", False),
    ("2026-04-24T18:30:00+24:00", False),
    ("", False),
]


def test_date_time(spark):
    got = checked(spark, *[changed(timestamp=text) for text, _ in DATE_TIMES]).orderBy("id").collect()
    assert [r["violations"] == [] for r in got] == [good for _, good in DATE_TIMES]


def test_positions_sort_as_numbers(spark):
    item = {"name": "n", "metric": "m", "value": "1", "unit": "u"}
    paths = [p for p, _ in found(spark, changed(results=[item] * 12))]
    assert paths == [f"results.{i}.value" for i in range(12)]


def test_no_object(spark):
    assert found_all(spark, "[1]", '"s"', "null", "not json") == [[("", "type")]] * 4


def test_null_members(spark):
    names = [("pr_number", None), ("seed", None), ("results", None), ("system", None), ("errors", [None])]
    assert found_all(spark, *[changed(**{k: v}) for k, v in names]) == [
        [],
        [("seed", "type")],
        [("results", "type")],
        [("system", "type")],
        [("errors.0", "type")],
    ]


def test_integer_semantics(spark):
    sizes = ["128.0", "1e2", "12345678901234567890", "1.5", '"128"']
    docs = [VALID_ENVELOPE.replace('"memory_gb": 96', f'"memory_gb": {size}') for size in sizes]
    wrong = [("system.memory_gb", "type")]
    got = found_all(spark, *docs, changed(seed=5), changed(seed=True))
    assert got == [[], [], [], wrong, wrong, [], [("seed", "type")]]


def test_wrong_type_of_a_text_with_rules(spark):
    assert found(spark, changed(git_sha=1234567, suite=1)) == [("git_sha", "type"), ("suite", "type"), ("suite", "enum")]


def test_summary_and_downgrade(spark):
    df = checked(spark, VALID_ENVELOPE, INVALID_ENVELOPE, INVALID_ENVELOPE)
    summary = {(r["rule"], r["keyword"], r["path"]): r["n"] for r in VA.violation_summary(df).collect()}
    assert summary[("V5", "pattern", "git_sha")] == 2 and len(summary) == 7
    noted = VA.downgrade(df.withColumn("errors", F.array(F.lit("earlier"))))
    errors = {r["id"]: r["errors"] for r in noted.collect()}
    assert errors[0] == ["earlier"] and len(errors[1]) == 8
    assert "missing key: memory_gb (at $system)" in errors[1]


def test_split(spark):
    good, bad = VA.split_valid(checked(spark, VALID_ENVELOPE, INVALID_ENVELOPE))
    assert [r["id"] for r in good.collect()] == [0] and [r["id"] for r in bad.collect()] == [1]


def test_typed_envelope_flattens(spark):
    df = parse_documents(spark.createDataFrame([(1, VALID_ENVELOPE)], "id int, raw string"))
    rows = tags_to_columns(flatten(VA.typed_envelopes(df, ["id"]), ["id"]))
    row = rows.first()
    assert rows.count() == 1
    assert row["tag_lm_eval_key"] == "exact_match,flexible-extract"
    assert row["duration_seconds"] == 61.75 and row["memory_gb"] == 96 and row["suite"] == "reasoning"


def test_large_arrays(spark):
    items = [{"name": "n", "metric": "m", "value": i, "unit": "u"} for i in range(5000)]
    items[4321]["value"] = "x"
    assert found(spark, changed(results=items)) == [("results.4321.value", "type")]


def test_typed_columns_and_documents_report_the_same(spark):
    result = {"name": "n", "metric": "m", "value": 1.0, "unit": "u", "tags": {"a": "b"}}
    partial = {k: v for k, v in result.items() if k not in ("metric", "unit")}
    docs = [
        VALID_ENVELOPE,
        INVALID_ENVELOPE,
        changed(git_sha="unknown", suite="x", timestamp="2026-02-30T00:00:00Z"),
        changed(results=[result] * 11 + [partial]),
        changed(memory_snapshots=[{"phase": "p", "rss_gb": 1.0}, {"phase": "q"}]),
        json.dumps({"schema_version": "1"}),
        "{}",
    ]
    both = checked(spark, *docs).orderBy("id").collect()
    typed = VA.with_typed_violations(VA.typed_envelopes(checked(spark, *docs), ["id"])).orderBy("id").collect()
    assert [r["violations"] for r in typed] == [r["violations"] for r in both]


def test_typed_columns_with_null_elements(spark):
    df = VA.typed_envelopes(checked(spark, VALID_ENVELOPE), ["id"]).withColumn("errors", F.expr("array('a', CAST(NULL AS STRING))"))
    tags = F.expr("transform(results, r -> named_struct('name', r.name, 'metric', r.metric, 'value', DOUBLE('Infinity'), 'unit', r.unit, "
                  "'duration_seconds', r.duration_seconds, 'tags', map('k', CAST(NULL AS STRING)), 'raw', r.raw))")
    found_ = VA.with_typed_violations(df.withColumn("results", tags)).first()["violations"]
    assert [(".".join(v["path"]), v["keyword"]) for v in found_] == [("errors.1", "type"), ("results.0.tags.k", "type")]


def test_keys_that_look_like_positions_stay_keys(spark):
    result = {"name": "n", "metric": "m", "value": 1.0, "unit": "u", "tags": {"2024": 1, "7": 2}}
    df = checked(spark, changed(results=[result, result]))
    assert {r["path"] for r in VA.violation_summary(df).collect()} == {"results.*.tags.2024", "results.*.tags.7"}


def test_integers_beyond_64_bits_are_reported(spark):
    big = 18446744073709551615
    assert found(spark, changed(seed=big, pr_number=-big)) == [("pr_number", "range"), ("seed", "range")]
    assert found(spark, changed(seed=2**63 - 1)) == []
