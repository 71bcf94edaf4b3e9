"""Envelope validation: every violation of every document, in one narrow pass.

A document is checked as VARIANT, since a wrong type has to be seen before anything is cast. The checks build one
array per document, so nothing is exploded, joined or shuffled. Violations carry the
number of the rule they come from (``V1`` to ``V19``), the keyword that failed and the path to the value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.functions import variants as V
from evalspark.functions.let import computed_once, let
from evalspark.functions.maps import empty_string_map
from evalspark.schemas import (
    ENVELOPE_COLUMNS,
    ENVELOPE_DDL,
    REQUIRED_KEYS,
    SCHEMA_VERSION,
    SUITES,
    SYSTEM_FIELDS,
    TRIGGERS,
)

# Fixed values of the published schema.
SHA_PATTERN = "^[0-9a-fA-F]{7,64}$"
SHA_MIN_LENGTH = 7
RESULT_FIELDS = [
    ("name", "string"),
    ("metric", "string"),
    ("value", "number"),
    ("unit", "string"),
    ("duration_seconds", "number"),
    ("tags", "object"),
    ("raw", "any"),
]
RESULT_REQUIRED = ["name", "metric", "value", "unit"]
SNAPSHOT_FIELDS = [
    ("phase", "string"),
    ("rss_gb", "number"),
    ("free_gb", "number"),
    ("wired_gb", "number"),
    ("swap_mb", "number"),
]
SNAPSHOT_REQUIRED = ["phase", "rss_gb"]
GEN_KWARGS_FIELDS = [("max_gen_toks", "integer"), ("temperature", "number"), ("top_p", "number"), ("top_k", "integer")]
SYSTEM_REQUIRED = ["os", "chip", "memory_gb"]
# end of fixed values

# Members of an envelope that are lists.
LISTS = ["results", "memory_snapshots", "errors"]
# RFC 3339: a zone is required, seconds end at 59. Letters may be in lower case.
DATE_TIME = (
    r"(?id)\A[0-9]{4}-(0[1-9]|1[0-2])-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]+)?"
    r"(Z|[+-]([01][0-9]|2[0-3]):[0-5][0-9])$"
)

VIOLATION = "struct<path: array<string>, rule: string, keyword: string, detail: string>"

def violation(path: Column, rule: str | Column, keyword: str, detail: str | Column) -> Column:
    return F.struct(
        path.alias("path"),
        (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"),
        F.lit(keyword).alias("keyword"),
        (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"),
    )


def at(*steps: str | Column) -> Column:
    """Path to a value as an array of keys and positions."""
    if not steps:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(s) if isinstance(s, str) else s for s in steps])


def no_violations() -> Column:
    return F.array().cast(f"array<{VIOLATION}>")


def wrong_types(m: Column, fields: list[tuple[str, str, str]], path: Column) -> Column:
    """Members of an object that do not have the type given in ``(name, type, rule)``.

    The table goes into the plan as a literal array and one lambda walks it, so the size of the expression does not
    grow with the number of fields.
    """
    wanted = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(r).alias("rule")) for n, t, r in fields]
    )

    def fails(f: Column) -> Column:
        v = m[f["name"]]
        return v.isNotNull() & ~let(V.kind(v), lambda t: V.has_type(v, t, f["type"]))

    return F.transform(
        F.filter(wanted, lambda f: fails(f)),
        lambda f: violation(
            F.concat(path, F.array(f["name"])), f["rule"], "type", F.concat(F.lit("not of type "), f["type"])
        ),
    )


def missing_keys(m: Column, names: list[str], path: Column, rule: str) -> Column:
    missing = F.array_except(F.array(*[F.lit(n) for n in names]), F.map_keys(m))
    return F.transform(missing, lambda n: violation(path, rule, "required", F.concat(F.lit("missing key: "), n)))


def unknown_keys(m: Column, names: list[str], path: Column, rule: str) -> Column:
    unknown = F.array_sort(F.array_except(F.map_keys(m), F.array(*[F.lit(n) for n in names])))

    def listed(u: Column) -> Column:
        detail = F.concat(F.lit("unexpected keys: "), F.array_join(u, ", "))
        return F.when(F.size(u) > 0, F.array(violation(path, rule, "additionalProperties", detail)))

    return F.coalesce(let(unknown, listed), no_violations())


def members(m: Column, fields: list[tuple[str, str]], needed: list[str], path: Column, rule: str) -> Column:
    """Violations of an object with a closed set of members, given as a map; none where it is NULL."""
    checked = [(n, t, rule) for n, t in fields if t not in ("any", "object")]
    found = F.concat(
        missing_keys(m, needed, path, rule) if needed else no_violations(),
        unknown_keys(m, [n for n, _ in fields], path, rule),
        wrong_types(m, checked, path),
    )
    return F.when(m.isNull(), no_violations()).otherwise(found)


def _each(array: Column, check: Callable[[Column, Column], Column]) -> Column:
    """Violations of every element of an array given as variants; none where it is NULL."""
    per_item = F.transform(array, lambda item, i: check(item, i.cast("string")))
    return F.coalesce(F.flatten(per_item), no_violations())


def _not_object(item: Column, m: Column, path: Column, rule: str) -> Column:
    bad = item.isNotNull() & m.isNull()
    return F.when(bad, F.array(violation(path, rule, "type", "not of type object"))).otherwise(no_violations())


def _result(item: Column, i: Column) -> Column:
    path = at("results", i)

    def parts(m: Column) -> Column:
        tags = m["tags"]
        return F.concat(
            _not_object(item, m, path, "V14"),
            members(m, RESULT_FIELDS, RESULT_REQUIRED, path, "V14"),
            let(V.fields(tags), lambda t: F.concat(_not_object(tags, t, at("results", i, "tags"), "V15"), _tags(t, i))),
        )

    return let(V.fields(item), parts)


def _tags(tags: Column, i: Column) -> Column:
    not_text = F.map_filter(F.coalesce(tags, V.no_fields()), lambda _, v: V.kind(v) != "STRING")
    return F.transform(
        F.map_keys(not_text), lambda k: violation(at("results", i, "tags", k), "V15", "type", "not of type string")
    )


def _snapshot(item: Column, i: Column) -> Column:
    path = at("memory_snapshots", i)

    def parts(m: Column) -> Column:
        own = members(m, SNAPSHOT_FIELDS, SNAPSHOT_REQUIRED, path, "V17")
        return F.concat(_not_object(item, m, path, "V17"), own)

    return let(V.fields(item), parts)


def _error(item: Column, i: Column) -> Column:
    bad = V.kind(item) != "STRING"
    found = F.array(violation(at("errors", i), "V18", "type", "not of type string"))
    return F.when(bad, found).otherwise(no_violations())


def is_date_time(s: Column) -> Column:
    """Shape and calendar: a cast alone takes ``2026-04-24 18:30``, a pattern alone takes 30 February."""
    day = F.left(s, F.lit(10))
    return s.isNotNull() & s.rlike(DATE_TIME) & ~s.startswith("0000") & day.try_cast("date").isNotNull()


TOP_TYPES = [
    ("schema_version", "string", "V3"),
    ("timestamp", "string", "V4"),
    ("git_sha", "string", "V5"),
    ("trigger", "string", "V6"),
    ("pr_number", "integer or null", "V7"),
    ("suite", "string", "V8"),
    ("model", "string", "V9"),
    ("model_revision", "string", "V9"),
    ("quantization", "string", "V9"),
    ("skipped", "boolean", "V10"),
    ("seed", "integer", "V11"),
]


def _stated(texts: Column, present: Callable[[str], Column]) -> Column:
    """Violations by what a member says, as against its type. ``texts`` has the members as strings."""

    def not_in(s: Column, name: str, values: list[str], rule: str, keyword: str, detail: str) -> Column:
        allowed = s[name].isNotNull() & s[name].isin(*values)
        return F.when(present(name) & ~allowed, violation(at(name), rule, keyword, detail))

    def found(s: Column) -> Column:
        sha, stamp = s["git_sha"], s["timestamp"]
        return F.array(
            not_in(s, "schema_version", [SCHEMA_VERSION], "V3", "const", f"'{SCHEMA_VERSION}' was expected"),
            F.when(stamp.isNotNull() & ~is_date_time(stamp), violation(at("timestamp"), "V4", "format", "not a date-time")),
            F.when(
                F.length(sha) < SHA_MIN_LENGTH,
                violation(at("git_sha"), "V5", "minLength", f"shorter than {SHA_MIN_LENGTH} characters"),
            ),
            F.when(
                ~sha.rlike("(?d)" + SHA_PATTERN),
                violation(at("git_sha"), "V5", "pattern", f"does not match {SHA_PATTERN}"),
            ),
            not_in(s, "trigger", TRIGGERS, "V6", "enum", "not one of the allowed values"),
            not_in(s, "suite", SUITES, "V8", "enum", "not one of the allowed values"),
        )

    return F.array_compact(let(texts, found))


STATED = ("schema_version", "timestamp", "git_sha", "trigger", "suite")


def checks(m: Column, parts: Column) -> Column:
    """All violations of a document: ``m`` maps its top-level members, ``parts`` holds those opened further."""

    def wrong(name: str, opened: Column, kind: str, rule: str) -> Column:
        return F.when(m[name].isNotNull() & opened.isNull(), violation(at(name), rule, "type", f"not of type {kind}"))

    gen, system, results = parts["gen_kwargs"], parts["system"], parts["results"]
    snapshots, errors = parts["memory_snapshots"], parts["errors"]
    containers = F.array(
        *[
            F.when(m[n].isNotNull() & V.too_wide(m[n]), violation(at(n), rule, "range", "does not fit 64 bits"))
            for n, rule in (("pr_number", "V7"), ("seed", "V11"))
        ],
        wrong("gen_kwargs", gen, "object", "V12"),
        wrong("system", system, "object", "V13"),
        wrong("results", results, "array", "V14"),
        wrong("memory_snapshots", snapshots, "array", "V17"),
        wrong("errors", errors, "array", "V18"),
    )
    return F.concat(
        missing_keys(m, REQUIRED_KEYS, at(), "V1"),
        unknown_keys(m, ENVELOPE_COLUMNS, at(), "V2"),
        wrong_types(m, TOP_TYPES, at()),
        _stated(F.struct(*[V.string(m[n]).alias(n) for n in STATED]), lambda n: m[n].isNotNull()),
        F.array_compact(containers),
        members(gen, GEN_KWARGS_FIELDS, [], at("gen_kwargs"), "V12"),
        members(system, SYSTEM_FIELDS, SYSTEM_REQUIRED, at("system"), "V13"),
        _each(results, _result),
        _each(snapshots, _snapshot),
        _each(errors, _error),
    )


def is_position(path: Column, step: Column) -> Column:
    """Whether a step of a path is a place in an array: only the second one below a list of the envelope is. A key may
    look like a number and is a key all the same."""
    return (step == 1) & F.get(path, F.lit(0)).isin(*LISTS)


def by_path(found: Column) -> Column:
    """Violations in order of their paths, array positions as numbers; within a path in the order of the rules."""
    keyed = F.transform(
        found,
        lambda x, i: F.struct(
            F.transform(x["path"], lambda p, n: F.when(is_position(x["path"], n), F.lpad(p, 12, "0")).otherwise(p)).alias("at"),
            i.alias("i"),
            x.alias("x"),
        ),
    )
    return F.transform(F.array_sort(keyed), lambda k: k["x"])


def with_violations(df: DataFrame) -> DataFrame:
    """Add ``violations`` to documents (``doc``); a document that is no object has that one violation."""
    m = F.col("_m")
    opened = df.withColumn("_m", V.fields(F.col("doc")))
    parts = F.struct(
        V.fields(m["gen_kwargs"]).alias("gen_kwargs"),
        V.fields(m["system"]).alias("system"),
        V.items(m["results"]).alias("results"),
        V.items(m["memory_snapshots"]).alias("memory_snapshots"),
        V.items(m["errors"]).alias("errors"),
    )
    opened = opened.withColumn("_parts", parts)
    no_object = F.array(violation(at(), "V1", "type", "not of type object"))
    found = let(checks(m, F.col("_parts")), lambda f: F.when(F.size(f) > 0, by_path(f)).otherwise(f))
    found = F.when(m.isNull(), no_object).otherwise(found)
    return computed_once(opened.withColumn("violations", found).drop("_m", "_parts"))


def _absent(present: list[tuple[str, Column]], path: Column, rule: str) -> Column:
    """A violation for each required member that is NULL."""
    return F.array_compact(
        F.array(*[F.when(c.isNull(), violation(path, rule, "required", f"missing key: {n}")) for n, c in present])
    )


def with_typed_violations(envelopes: DataFrame) -> DataFrame:
    """Add ``violations`` to typed envelope columns, as a converter makes them.

    Types hold by the schema of the columns and no key is unknown, so what is left is what may be missing and what the
    members say. The elements of an array are gone through a second time only where one of them is incomplete.
    """

    def incomplete(array: str, needed: list[str], rule: str) -> Column:
        c = F.col(array)

        def lacks(r: Column) -> Column:
            missing = r[needed[0]].isNull()
            for n in needed[1:]:
                missing = missing | r[n].isNull()
            return missing

        def listed(r: Column, i: Column) -> Column:
            return _absent([(n, r[n]) for n in needed], at(array, i.cast("string")), rule)

        return F.when(F.exists(c, lacks), F.flatten(F.transform(c, listed)))

    def bad_tags(r: Column, i: Column) -> Column:
        empty = F.map_filter(F.coalesce(r["tags"], empty_string_map()), lambda _, v: v.isNull())
        place = i.cast("string")
        return F.transform(
            F.map_keys(empty), lambda k: violation(at("results", place, "tags", k), "V15", "type", "not of type string")
        )

    def null_tag(r: Column) -> Column:
        return F.exists(F.map_values(r["tags"]), lambda v: v.isNull())

    def bad_error(e: Column, i: Column) -> Column:
        return F.when(e.isNull(), violation(at("errors", i.cast("string")), "V18", "type", "not of type string"))

    machine = _absent([(n, F.col(f"system.{n}")) for n in SYSTEM_REQUIRED], at("system"), "V13")
    found = [
        _absent([(n, F.col(n)) for n in REQUIRED_KEYS], at(), "V1"),
        _stated(F.struct(*[F.col(n) for n in STATED]), lambda n: F.col(n).isNotNull()),
        F.when(F.col("system").isNotNull(), machine),
        incomplete("results", RESULT_REQUIRED, "V14"),
        F.when(F.exists("results", null_tag), F.flatten(F.transform("results", bad_tags))),
        incomplete("memory_snapshots", SNAPSHOT_REQUIRED, "V17"),
        F.array_compact(F.transform("errors", bad_error)),
    ]
    all_found = F.concat(*[F.coalesce(f, no_violations()) for f in found])
    ordered = let(all_found, lambda f: F.when(F.size(f) > 0, by_path(f)).otherwise(f))
    return computed_once(envelopes.withColumn("violations", ordered))


def violations(checked: DataFrame, keep: list[str]) -> DataFrame:
    """One row per violation with its position in the report of its document."""
    rows = checked.select(*keep, F.posexplode_outer("violations").alias("position", "v")).where(F.col("v").isNotNull())
    return rows.select(*keep, "position", "v.path", "v.rule", "v.keyword", "v.detail")


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantined)``; persist ``checked`` when both are written."""
    return checked.where(F.size("violations") == 0), checked.where(F.size("violations") > 0)


def violation_summary(checked: DataFrame) -> DataFrame:
    """How often each rule fails at each path. Array positions are left out so the table stays small."""
    rows = violations(checked, [])
    path = F.col("path")
    place = F.array_join(F.transform(path, lambda p, n: F.when(is_position(path, n), "*").otherwise(p)), ".")
    return rows.groupBy("rule", "keyword", place.alias("path")).agg(F.count(F.lit(1)).alias("n"))


def error_text(v: Column) -> Column:
    return F.concat(v["detail"], F.lit(" (at $"), F.array_join(v["path"], "."), F.lit(")"))


def downgrade(checked: DataFrame) -> DataFrame:
    """Keep every document and note its violations in ``errors`` instead of rejecting it."""
    noted = F.transform("violations", error_text)
    return checked.withColumn("errors", F.concat(F.coalesce("errors", F.array().cast("array<string>")), noted))


def typed_envelopes(df: DataFrame, keep: list[str]) -> DataFrame:
    """Documents as typed envelope columns. A part with a wrong type is NULL; validate first."""
    opened = df.withColumn("_m", V.fields(F.col("doc")))
    schema = T.StructType.fromDDL(ENVELOPE_DDL)
    return opened.select(
        *keep,
        *[F.try_variant_get(F.col("_m")[f.name], "$", f.dataType.simpleString()).alias(f.name) for f in schema],
    )


def envelope_variant(envelopes: DataFrame) -> Column:
    """Typed envelope columns as the document they stand for: missing parts are left out."""
    return F.parse_json(F.to_json(F.struct(*[F.col(c) for c in ENVELOPE_COLUMNS])))
