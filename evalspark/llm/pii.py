"""Personal data in texts: patterns propose spans, checks confirm them, words nearby move their scores.

Everything is column expressions. Positions come from the pieces between the matches; a document without matches costs
one search per kind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions.let import let

#: Code points before and after a span in which context words count, as far as the neighbouring spans of its kind.
CONTEXT = 40
#: What a context word adds to a score.
RAISE = 0.3
#: Kinds of this module's own are kept from this score on; the base kinds always.
LEAST_SCORE = 0.5

SPAN = "array<struct<start: int, at: int, end: int, kind: string, score: double>>"


@dataclass(frozen=True)
class Kind:
    """``pattern`` must not need backtracking over long runs; ``hint`` is a cheap test that holds wherever it matches."""

    name: str
    pattern: str
    score: float
    context: tuple[str, ...]
    valid: Callable[[Column], Column] = field(default=lambda m: F.lit(True), compare=False)
    hint: Callable[[Column], Column] = field(default=lambda t: F.lit(True), compare=False)
    base: bool = True


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """The Luhn sum of the digits ends in 0. For matches of a bounded number of digits."""

    def total(d: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            digit = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
            twice = digit * 2
            return acc + F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add) % 10 == 0

    return let(digits_of(match), total)


def mod_97(match: Column) -> Column:
    """The account number check: the first four characters moved to the end, letters as 10 to 35, remainder 1."""
    alphabet = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def rest(code: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            value = F.instr(F.lit(alphabet), F.substring(code, i, F.lit(1))) - 1
            return (acc * F.when(value > 9, 100).otherwise(10) + value) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(code)), F.lit(0), step) == 1

    plain = F.replace(match, F.lit(" "), F.lit(""))
    return let(plain, lambda p: rest(F.concat(F.substring(p, F.lit(5), F.length(p)), F.substring(p, 1, 4))))


def n_digits(least: int, most: int) -> Callable[[Column], Column]:
    return lambda match: F.length(digits_of(match)).between(least, most)


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: A run of characters is tried from its start, or from the end of the last match in it, and never given back.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.7,
        ("mail", "e-mail", "contact", "write", "schreib", "correo", "courriel"),
        hint=lambda t: F.contains(t, F.lit("@")),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.5,
        ("ip", "host", "server", "address", "adresse"),
        valid=lambda m: m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"),
        hint=lambda t: F.contains(t, F.lit(".")),
    ),
    Kind(
        "card",
        # Whole chains of 14 to 19 digits; shorter and longer chains are matches that fail.
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
        0.6,
        ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
        valid=luhn,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.5,
        ("phone", "tel", "call", "mobile", "telefon", "fax"),
        valid=n_digits(10, 15),
        hint=lambda t: F.contains(t, F.lit("+")),
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        0.8,
        ("iban", "account", "bank", "konto", "compte", "cuenta"),
        valid=mod_97,
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        0.3,
        ("ssn", "social security", "social-security"),
        base=False,
    ),
)


def before_each(numbers: Column) -> Column:
    """For each number the sum of those before it. Numbers go in about sqrt(n) blocks of sqrt(n), so that a text of very
    many matches costs n ** 1.5 steps and no array is built up element by element."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def blocks(width: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / width).cast("int")), lambda b: F.slice(numbers, b * width + 1, width))

        def sums(parts: Column) -> Column:
            def inside(heads: Column) -> Column:
                return F.flatten(
                    F.transform(
                        parts,
                        lambda part, b: let(
                            total(F.slice(heads, F.lit(1), b)),
                            lambda head: F.transform(part, lambda _, i: head + total(F.slice(part, F.lit(1), i))),
                        ),
                    )
                )

            return let(F.transform(parts, total), inside)

        return let(cut, sums)

    return F.when(F.size(numbers) > 0, let(F.ceil(F.sqrt(F.size(numbers))).cast("int"), blocks)).otherwise(F.array().cast("array<int>"))


def spans_of(text: Column, kind: Kind, at: int) -> Column:
    """The confirmed spans of one kind, as SPAN."""
    none = F.array().cast(SPAN)

    def placed(found: Column) -> Column:
        def between(gaps: Column) -> Column:
            lengths = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))

            def spans(heads: Column) -> Column:
                def span(m: Column, i: Column) -> Column:
                    before, after = F.get(gaps, i), F.get(gaps, i + 1)
                    start = F.get(heads, i) + F.length(before)
                    near = F.lower(F.concat(F.right(before, F.lit(CONTEXT)), F.lit(" "), F.left(after, F.lit(CONTEXT))))
                    hit = near.rlike("(?<![a-z])(?:" + "|".join(kind.context) + ")")
                    score = F.when(hit, min(1.0, kind.score + RAISE)).otherwise(kind.score)
                    keep = kind.valid(m) if kind.base else kind.valid(m) & (score >= LEAST_SCORE)
                    end = start + F.length(m)
                    parts = {"start": start, "at": F.lit(at), "end": end, "kind": F.lit(kind.name), "score": score}
                    return F.when(keep, F.struct(*[c.alias(n) for n, c in parts.items()]))

                return F.filter(F.transform(found, span), lambda s: s.isNotNull())

            return let(before_each(lengths), spans)

        return F.when(F.size(found) == 0, none).otherwise(let(F.split(text, kind.pattern, -1), between).cast(SPAN))

    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return F.when(kind.hint(text), let(matches, placed)).otherwise(none)


def find(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """One row per document: the columns ``keep`` and spans, sorted by start and then in the order of ``kinds``.

    A span is (start, end in code points, end exclusive; kind; score from 0 to 1). Matches are leftmost and do not
    overlap within a kind; one that fails its check is dropped and not tried again from inside. Null and empty texts
    have no spans. Repeated rows are rows of the result each; an empty table gives no rows; other columns are ignored.
    Narrow: no shuffle, no Python.
    """
    rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.coalesce(F.col(text), F.lit("")).alias("__text"))
    spans = F.sort_array(F.concat(*[spans_of(F.col("__text"), k, at) for at, k in enumerate(kinds)]))
    return rows.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], spans.alias("spans"))
