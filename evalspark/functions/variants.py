"""Typed access to untrusted JSON held as VARIANT.

``try_variant_get`` casts: a numeric string becomes a number and a boolean becomes 1.0. The type of a
value therefore has to be looked at before it is read, on every level of a document.

How number literals arrive: an integer that fits 64 bits is BIGINT, a longer one DECIMAL(19+, 0). A literal
with a fraction is DECIMAL with trailing zeros removed, so ``128.0`` is DECIMAL(3, 0); one with an exponent
is DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evalspark.functions.let import let


def number_kind(t: Column) -> Column:
    return t.isin("BIGINT", "DOUBLE", "FLOAT") | t.startswith("DECIMAL")


def integer_literal_kind(t: Column) -> Column:
    # DECIMAL(19,0) to DECIMAL(38,0): shorter ones were written with a fraction of zeros.
    two_digits = F.length(t) == len("DECIMAL(19,0)")
    return (t == "BIGINT") | (t.startswith("DECIMAL") & t.endswith(",0)") & two_digits & (t >= "DECIMAL(19"))


def fields(v: Column) -> Column:
    """Members of an object; NULL for any other value."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def items(v: Column) -> Column:
    """Elements of an array; NULL for any other value."""
    return F.try_variant_get(v, "$", "array<variant>")


def fields_of_fields(v: Column) -> Column:
    """Members of an object by name, each as the map of its own members; NULL for a member that is no object, and for any other value.
    Values are copied once, not once for each level."""
    return F.try_variant_get(v, "$", "map<string,map<string,variant>>")


def is_object(v: Column) -> Column:
    """Whether a value is an object. Nothing of it is copied, as :func:`fields` does."""
    return F.try_variant_get(v, "$", "struct<_: boolean>").isNotNull()


def no_fields() -> Column:
    return F.create_map().cast("map<string,variant>")


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def absent(v: Column) -> Column:
    """Key missing or JSON null."""
    return v.isNull() | F.is_variant_null(v)


def is_number(v: Column) -> Column:
    """JSON number; booleans are not numbers here."""
    return number_kind(kind(v))


def is_boolean(v: Column) -> Column:
    return kind(v) == "BOOLEAN"


def numeric_or_bool(v: Column, t: Column | None = None) -> Column:
    """Value as DOUBLE where it is a number or a boolean (true is 1.0), else NULL."""
    t = kind(v) if t is None else t
    return F.when(number_kind(t) | (t == "BOOLEAN"), F.try_variant_get(v, "$", "double"))


def integer_literal(v: Column) -> Column:
    """Value as BIGINT where it was written as an integer (``4096``, not ``4096.0``), else NULL."""
    return let(kind(v), lambda t: F.when(integer_literal_kind(t), F.try_variant_get(v, "$", "bigint")))


def too_wide(v: Column) -> Column:
    """Whether a value is an integer that 64 bits do not hold."""
    whole = let(kind(v), lambda t: has_type(v, t, F.lit("integer")))
    return F.coalesce(whole, F.lit(False)) & F.try_variant_get(v, "$", "bigint").isNull()


def string(v: Column) -> Column:
    return F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def has_type(v: Column, t: Column, wanted: Column) -> Column:
    """Whether ``v`` of kind ``t`` is of the JSON Schema type named by ``wanted``.

    A boolean is neither number nor integer; ``128.0`` and ``1e2`` are integers.
    """
    d = F.try_variant_get(v, "$", "double")
    integral = (t == "BIGINT") | (t.startswith("DECIMAL") & t.endswith(",0)")) | (t.isin("DOUBLE", "FLOAT") & (d == F.floor(d)))
    return (
        F.when(wanted == "string", t == "STRING")
        .when(wanted == "number", number_kind(t))
        .when(wanted == "integer", integral)
        .when(wanted == "integer or null", integral | (t == "VOID"))
        .when(wanted == "boolean", t == "BOOLEAN")
        .when(wanted == "object", t.startswith("OBJECT"))
        .when(wanted == "array", t.startswith("ARRAY"))
        .otherwise(True)
    )


def truthy(v: Column) -> Column:
    """False for a missing key, null, false, zero, and empty strings, arrays and objects."""

    def by_kind(t: Column) -> Column:
        return (
            F.when(t.isNull() | t.isin("VOID", "OBJECT<>"), False)
            .when(t == "STRING", F.try_variant_get(v, "$", "string") != "")
            .when(number_kind(t) | (t == "BOOLEAN"), F.try_variant_get(v, "$", "double") != 0)
            .when(t == "ARRAY<VOID>", F.size(items(v)) > 0)
            .otherwise(True)
        )

    return let(kind(v), by_kind)


def _spread(sign: Column, head: Column, frac: Column, exp: Column) -> Column:
    digits = F.concat(head, frac)
    width = exp + 1
    tail = F.coalesce(F.nullif(F.substring(digits, width + 1, F.length(digits)), F.lit("")), F.lit("0"))
    large = F.concat(sign, F.rpad(digits, width, "0"), F.lit("."), tail)
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    mantissa = F.concat(sign, head, F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(""))
    power = F.abs(exp).cast("string")
    power = F.when(F.length(power) < 2, F.concat(F.lit("0"), power)).otherwise(power)
    scientific = F.concat(mantissa, F.lit("e"), F.when(exp < 0, "-").otherwise("+"), power)
    return F.when((exp >= 7) & (exp < 16), large).when((exp < 0) & (exp >= -4), small).otherwise(scientific)


def float_text(d: Column) -> Column:
    """Text of a DOUBLE with the switch to exponents at 1e-4 and 1e16, two exponent digits at least.

    Spark's own cast switches at 1e-3 and 1e7.
    """
    pattern = r"^(-?)(\d)\.(\d+)E(-?\d+)$"

    def rewrite(s: Column) -> Column:
        parts = F.struct(
            F.regexp_extract(s, pattern, 1).alias("sign"),
            F.regexp_extract(s, pattern, 2).alias("head"),
            F.regexp_replace(F.regexp_extract(s, pattern, 3), "0+$", "").alias("frac"),
            F.regexp_extract(s, pattern, 4).try_cast("int").alias("exp"),
        )
        spread = let(parts, lambda p: _spread(p["sign"], p["head"], p["frac"], p["exp"]))
        return F.when(s.contains("E"), spread).otherwise(s)

    return let(d.cast("string"), rewrite)


def text(v: Column) -> Column:
    """Tag text of a value: strings as they are, ``100.0`` keeps its fraction, booleans are capitalised.

    Objects and arrays give their JSON text. A missing key and null give NULL.
    """

    def by_kind(t: Column) -> Column:
        return (
            F.when(t == "VOID", F.lit(None).cast("string"))
            .when((t == "STRING") | integer_literal_kind(t), F.try_variant_get(v, "$", "string"))
            .when(t == "BOOLEAN", F.initcap(F.try_variant_get(v, "$", "string")))
            .when(number_kind(t), float_text(F.try_variant_get(v, "$", "double")))
            .otherwise(F.to_json(v))
        )

    return let(kind(v), by_kind)
