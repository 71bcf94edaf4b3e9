"""Raw result documents: one JSON document per file, or one per line where a collector gathered them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.functions.let import computed_once, let


def load_text(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """``(path, raw)``. One row per file, or per non-blank line with ``lines=True``.

    A document has to fit in one row. Millions of small files list and open slowly: gather them as lines.
    """
    df = spark.read.text(path, wholetext=not lines)
    out = df.select(F.input_file_name().alias("path"), F.col("value").alias("raw"))
    return out.where(F.trim("raw") != "") if lines else out


def whole_document(text: Column) -> Column:
    """The VARIANT of a text that is one JSON value and nothing more but white space; NULL for any other text.

    A parser that is given the text alone stops after the first value: what follows, another document or half of one,
    would be lost in silence. So it is given an array of the text and of the text's own digest. The array has these two
    elements just where the text is one value: more values would be more elements, and a text that closes the array
    itself would have to end in its own digest.
    """
    digest = F.md5(text)
    both = F.from_json(F.concat(F.lit("["), text, F.lit(',"'), digest, F.lit('"]')), "variant", {"allowSingleQuotes": "false"})

    def value(array: Column) -> Column:
        alone = F.try_variant_get(array, "$[2]", "variant").isNull() & (F.try_variant_get(array, "$[1]", "string") == digest)
        return F.when(alone & ~other_infinity(text), F.try_variant_get(array, "$[0]", "variant"))

    return let(both, value)


def other_infinity(text: Column) -> Column:
    """Whether a text has ``INF`` or ``+Infinity`` outside of strings: the parser reads them, but they are no JSON to anyone else.

    Only texts that have the letters at all are looked at closely: first escapes go, then strings.
    """
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), '"[^"]*"', '""')
    found = F.regexp_like(bare, F.lit(r"INF|\+Infinity"))
    return F.when(text.contains("INF") | text.contains("+Infinity"), found).otherwise(False)


def parse_documents(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add ``doc``; it is NULL where the text is not one JSON document.

    Beyond strict JSON, what common tools write is read: ``NaN`` and ``Infinity`` are numbers that are not finite, and
    of a repeated key the last value counts. For the latter the session needs the settings of
    :func:`evalspark.session.configure`; without them this is refused, as documents would be.
    """
    if df.sparkSession.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        raise RuntimeError("call evalspark.session.configure(spark) first: documents may repeat a key")
    return computed_once(df.withColumn("doc", whole_document(F.col(raw))))


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(documents, rejects)`` by whether the text could be parsed.

    Two actions on the two results read the input twice; persist ``parsed`` where that matters.
    """
    rejects = parsed.where(F.col("doc").isNull()).drop("doc")
    return parsed.where(F.col("doc").isNotNull()), rejects.withColumn("reason", F.lit("not valid JSON"))


def read_raw(spark: SparkSession, path: str | list[str], lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(path, raw, doc)`` of the readable documents, and ``(path, raw, reason)`` of the others."""
    return split_parsed(parse_documents(load_text(spark, path, lines)))
