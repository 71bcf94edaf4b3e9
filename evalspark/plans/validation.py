"""Queries over envelopes with known faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark.functions import variants as V
from evalspark.functions.let import let
from evalspark.operators import validate as VA
from evalspark.plans.bindings import spread, table
from evalspark.plans.registry import query
from evalspark.sources.raw import parse_documents

# One class of faults per order, chosen by its key; what each class changes in an otherwise valid document.
FAULTS = {
    1: {"model": None, "system": None},
    2: {"_more": '"extra": 1, "zzz": null'},
    3: {"schema_version": '"2"'},
    4: {"schema_version": "1"},
    5: {"timestamp": '"2026-04-24 18:30"'},
    6: {"timestamp": '"2026-02-30T00:00:00Z"'},
    7: {"git_sha": '"XYZ"'},
    8: {"trigger": '"cron"'},
    9: {"pr_number": '"12"'},
    10: {"suite": '"no-such"'},
    11: {"model": "5", "model_revision": "true", "quantization": "[]"},
    12: {"skipped": '"yes"'},
    13: {"seed": "1.5"},
    14: {"gen_kwargs": '{"max_gen_toks": "x", "temperature": true, "beam": 1}'},
    15: {"system": '{"os": "o", "memory_gb": 64.5, "kernel": 3}'},
    16: {"results": '"none"'},
    17: {"results": '[{"name": "n", "metric": "m", "value": 1, "unit": "u"}, {"name": "n", "value": "1", "unit": "u", "x": 1}, 7]'},
    18: {"results": '[{"name": "n", "metric": "m", "value": 1, "unit": "u", "tags": {"a": 1, "b": "x"}}]'},
    19: {"results": '[{"name": "n", "metric": "m", "value": 1, "unit": "u", "tags": "t"}]'},
    20: {"results": '[{"name": "n", "metric": "m", "value": 1, "unit": "u", "raw": {"x": [1, 2, null]}}]'},
    21: {"memory_snapshots": '[{"phase": "p", "rss_gb": "1"}, {"phase": "q", "rss_gb": 1, "gpu": 2}, 3, {"rss_gb": 2.5}]'},
    22: {"errors": '["a", 1]'},
    23: {"pr_number": "true", "seed": "false", "results": '[{"name": "n", "metric": "m", "value": true, "unit": "u"}]'},
    24: {"pr_number": "null", "seed": "5.0", "system": '{"os": "o", "chip": "c", "memory_gb": 128.0}'},
    25: {"results": "[]"},
    26: {"timestamp": '"2026-04-24t18:30:00.25+02:00"', "git_sha": "7", "trigger": "null"},
}
N_CLASSES = len(FAULTS) + 1

# What must be reported for each class, read off the published schema: (class, path, rule, keyword, detail).
_OBJECT, _STRING, _INTEGER, _NUMBER = (f"not of type {t}" for t in ("object", "string", "integer", "number"))
_ENUM = "not one of the allowed values"
EXPECTED = [
    (1, "", "V1", "required", "missing key: model"),
    (1, "", "V1", "required", "missing key: system"),
    (2, "", "V2", "additionalProperties", "unexpected keys: extra, zzz"),
    (3, "schema_version", "V3", "const", "'1' was expected"),
    (4, "schema_version", "V3", "type", _STRING),
    (4, "schema_version", "V3", "const", "'1' was expected"),
    (5, "timestamp", "V4", "format", "not a date-time"),
    (6, "timestamp", "V4", "format", "not a date-time"),
    (7, "git_sha", "V5", "minLength", "shorter than 7 characters"),
    (7, "git_sha", "V5", "pattern", "does not match ^[0-9a-fA-F]{7,64}$"),
    (8, "trigger", "V6", "enum", _ENUM),
    (9, "pr_number", "V7", "type", "not of type integer or null"),
    (10, "suite", "V8", "enum", _ENUM),
    (11, "model", "V9", "type", _STRING),
    (11, "model_revision", "V9", "type", _STRING),
    (11, "quantization", "V9", "type", _STRING),
    (12, "skipped", "V10", "type", "not of type boolean"),
    (13, "seed", "V11", "type", _INTEGER),
    (14, "gen_kwargs", "V12", "additionalProperties", "unexpected keys: beam"),
    (14, "gen_kwargs.max_gen_toks", "V12", "type", _INTEGER),
    (14, "gen_kwargs.temperature", "V12", "type", _NUMBER),
    (15, "system", "V13", "required", "missing key: chip"),
    (15, "system.kernel", "V13", "type", _STRING),
    (15, "system.memory_gb", "V13", "type", _INTEGER),
    (16, "results", "V14", "type", "not of type array"),
    (17, "results.1", "V14", "required", "missing key: metric"),
    (17, "results.1", "V14", "additionalProperties", "unexpected keys: x"),
    (17, "results.1.value", "V14", "type", _NUMBER),
    (17, "results.2", "V14", "type", _OBJECT),
    (18, "results.0.tags.a", "V15", "type", _STRING),
    (19, "results.0.tags", "V15", "type", _OBJECT),
    (21, "memory_snapshots.0.rss_gb", "V17", "type", _NUMBER),
    (21, "memory_snapshots.1", "V17", "additionalProperties", "unexpected keys: gpu"),
    (21, "memory_snapshots.2", "V17", "type", _OBJECT),
    (21, "memory_snapshots.3", "V17", "required", "missing key: phase"),
    (22, "errors.1", "V18", "type", _STRING),
    (23, "pr_number", "V7", "type", "not of type integer or null"),
    (23, "results.0.value", "V14", "type", _NUMBER),
    (23, "seed", "V11", "type", _INTEGER),
    (26, "git_sha", "V5", "type", _STRING),
    (26, "trigger", "V6", "type", _STRING),
    (26, "trigger", "V6", "enum", _ENUM),
]


def _member(name: str, valid: str) -> str:
    """Text of one member: its valid form, or what the order's class puts there (nothing for a missing key)."""
    cases = []
    for number, change in FAULTS.items():
        if name in change:
            value = change[name]
            text = "''" if value is None else "'" + f', "{name}": {value}' + "'"
            cases.append(f"WHEN {number} THEN {text}")
    usual = f"concat(', \"{name}\": ', {valid})" if valid else "''"
    return f"CASE o_orderkey % {N_CLASSES} {' '.join(cases)} ELSE {usual} END" if cases else usual


_MEMBERS = {
    "schema_version": "'\"1\"'",
    "timestamp": "concat('\"', date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\"), '\"')",
    "git_sha": "concat('\"', lpad(CAST(o_orderkey AS STRING), 8, '0'), '\"')",
    "trigger": "'\"local\"'",
    "pr_number": "",
    "suite": "'\"reasoning\"'",
    "model": "concat('\"model-', o_custkey, '\"')",
    "model_revision": "",
    "quantization": "",
    "skipped": "'false'",
    "seed": "CAST(o_orderkey AS STRING)",
    "gen_kwargs": "'{\"max_gen_toks\": 4096, \"temperature\": 0.0}'",
    "system": "'{\"os\": \"o\", \"chip\": \"c\", \"memory_gb\": 128}'",
    "results": "concat('[{\"name\": \"n\", \"metric\": \"m\", \"value\": ', o_totalprice, ', \"unit\": \"u\", \"tags\": {\"k\": \"v\"}}]')",
    "memory_snapshots": "",
    "errors": "'[]'",
}
_MORE = f"CASE o_orderkey % {N_CLASSES} WHEN 2 THEN ', {FAULTS[2]['_more']}' ELSE '' END"
# The first member has no comma in front.
DOCUMENT = f"concat('{{', substring(concat({', '.join(_member(n, v) for n, v in _MEMBERS.items())}, {_MORE}), 3), '}}')"


def faulty_envelopes(spark, sf_dir):
    """``o_orderkey, raw``: one envelope per order as text, with the faults of its class."""
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice"))
    return orders.selectExpr("o_orderkey", f"{DOCUMENT} AS raw")


def checked(spark, sf_dir):
    return VA.with_violations(parse_documents(faulty_envelopes(spark, sf_dir)))


_ROWS = ", ".join(
    "({}, {}, '{}', '{}', '{}', '{}')".format(c, i, p, r, k, d.replace("'", "''"))
    for i, (c, p, r, k, d) in enumerate(EXPECTED)
)
EXPECTED_SQL = f"""
expected AS (
  SELECT class, path, rule, keyword, detail,
         row_number() OVER (PARTITION BY class ORDER BY i) - 1 AS position
  FROM (VALUES {_ROWS}) AS t(class, i, path, rule, keyword, detail)
),
found AS (SELECT o_orderkey, expected.* FROM orders JOIN expected ON class = o_orderkey % {N_CLASSES})"""


@query(
    "v0a_violations",
    f"WITH {EXPECTED_SQL} SELECT o_orderkey, CAST(position AS INTEGER) AS position, path, rule, keyword, detail FROM found",
)
def v0a_violations(spark, sf_dir):
    rows = VA.violations(checked(spark, sf_dir), ["o_orderkey"])
    return rows.withColumn("path", F.array_join("path", "."))


@query(
    "v0b_split_valid",
    f"""WITH {EXPECTED_SQL} SELECT o_orderkey FROM orders
        WHERE o_orderkey % {N_CLASSES} NOT IN (SELECT class FROM expected)""",
)
def v0b_split_valid(spark, sf_dir):
    return VA.split_valid(checked(spark, sf_dir))[0].select("o_orderkey")


@query(
    "v0b_split_valid_quarantined",
    f"WITH {EXPECTED_SQL} SELECT o_orderkey, count(*) AS n FROM found GROUP BY o_orderkey",
)
def v0b_split_valid_quarantined(spark, sf_dir):
    bad = VA.split_valid(checked(spark, sf_dir))[1]
    return bad.select("o_orderkey", F.size("violations").cast("bigint").alias("n"))


@query(
    "v0c_violation_summary",
    f"""WITH {EXPECTED_SQL} SELECT rule, keyword, regexp_replace(path, '\\b[0-9]+\\b', '*', 'g') AS path, count(*) AS n
        FROM found GROUP BY ALL""",
)
def v0c_violation_summary(spark, sf_dir):
    return VA.violation_summary(checked(spark, sf_dir))


@query(
    "v0d_downgrade",
    f"""WITH {EXPECTED_SQL} SELECT o_orderkey, concat_ws('; ', CASE WHEN o_orderkey % 3 = 0 THEN 'noted before' END,
          string_agg(detail || ' (at $' || path || ')', '; ' ORDER BY position)) AS errors
        FROM orders LEFT JOIN found USING (o_orderkey) GROUP BY o_orderkey""",
)
def v0d_downgrade(spark, sf_dir):
    """A third of the documents bring an error of their own, which stays in front."""
    own = F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit("noted before"))).cast("array<string>")
    noted = VA.downgrade(checked(spark, sf_dir).withColumn("errors", own))
    return noted.select("o_orderkey", F.array_join("errors", "; ").alias("errors"))


RULES = {
    "V1": "required_keys",
    "V2": "unknown_keys",
    "V3": "schema_version",
    "V4": "timestamp",
    "V5": "git_sha",
    "V6": "trigger",
    "V7": "pr_number",
    "V8": "suite",
    "V9": "names",
    "V10": "skipped",
    "V11": "seed",
    "V12": "gen_kwargs",
    "V13": "system",
    "V14": "results",
    "V15": "tags",
    "V17": "memory_snapshots",
    "V18": "errors",
}


def _register_rule(rule: str, name: str) -> None:
    @query(
        f"{rule.lower()}_{name}",
        f"WITH {EXPECTED_SQL} SELECT o_orderkey, path, keyword, detail FROM found WHERE rule = '{rule}'",
    )
    def violations_of_rule(spark, sf_dir):
        rows = VA.violations(checked(spark, sf_dir), ["o_orderkey"]).where(F.col("rule") == rule)
        return rows.select("o_orderkey", F.array_join("path", ".").alias("path"), "keyword", "detail")


for _rule, _name in RULES.items():
    _register_rule(_rule, _name)


@query(
    "v16_raw",
    f"""WITH {EXPECTED_SQL}, n AS (SELECT o_orderkey, count(*) AS n FROM found GROUP BY o_orderkey)
        SELECT o_orderkey, CASE o_orderkey % {N_CLASSES} WHEN 20 THEN '{{"x":[1,2,null]}}' END AS raw,
          coalesce(n, 0) AS n_violations
        FROM orders LEFT JOIN n USING (o_orderkey)""",
)
def v16_raw(spark, sf_dir):
    """Anything may stand in ``raw``: the class that has it reports nothing."""
    raw = F.to_json(F.try_variant_get("doc", "$.results[0].raw", "variant"))
    n = F.size("violations").cast("bigint")
    return checked(spark, sf_dir).select("o_orderkey", raw.alias("raw"), n.alias("n_violations"))


@query(
    "v19_type_semantics",
    f"""SELECT o_orderkey, CASE o_orderkey % {N_CLASSES} WHEN 13 THEN false WHEN 23 THEN false ELSE true END AS seed_is_integer,
          o_orderkey % {N_CLASSES} = 23 AS value_is_boolean
        FROM orders""",
)
def v19_type_semantics(spark, sf_dir):
    """Booleans are no numbers, ``5.0`` is an integer: the seed and the first value of every document."""
    seed = F.try_variant_get("doc", "$.seed", "variant")
    integer = let(V.kind(seed), lambda t: V.has_type(seed, t, F.lit("integer")))
    value = F.try_variant_get("doc", "$.results[0].value", "variant")
    docs = parse_documents(faulty_envelopes(spark, sf_dir))
    return docs.select(
        "o_orderkey", integer.alias("seed_is_integer"), F.coalesce(V.is_boolean(value), F.lit(False)).alias("value_is_boolean")
    )
