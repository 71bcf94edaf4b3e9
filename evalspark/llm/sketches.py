"""Document fingerprints: bottom-k sketches of word shingle hashes.

The k least distinct hashes of a text's shingles are a uniform sample of its set of shingles. Two sketches merge to the
sketch of both texts, and estimate resemblance, containment and the number of distinct shingles. All column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evalspark.functions.let import let
from evalspark.llm.order import numbered

K = 64
SHINGLE = 5


def _least(hashes: Column, k: int) -> Column:
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """array<long>, rising. Words are split at white space after lower-casing; fewer words than a shingle are one
    shingle, no words none. The whole text is hashed; null is empty."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+", -1), lambda w: w != "")

    def hashes(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(w) - shingle), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(shingle)]))
        few = F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(w) >= shingle, _least(each, k)).otherwise(few)

    return let(words, hashes)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of both sets."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both (0 to 1); exact while the union has at most k. Two sketches
    without shingles are alike."""
    both = let(merge(a, b, k), lambda m: F.size(F.array_intersect(F.array_intersect(m, a), b)) / F.greatest(F.size(m), F.lit(1)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Exact below k, else estimated from the k-th least hash."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; an empty a is contained in everything."""
    j = resemblance(a, b, k)
    common = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def digits(a: Column) -> Column:
    """16 lowercase hex digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_half_of_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_chars, edited (text), sketch, edited_sketch, next_sketch.

    ``edited`` is the text with its last floor(n_chars / 2) code points replaced by as many from the start of the next
    document, or all it has. Documents follow each other by doc_id (null first), then by a hash of their text; after the
    last comes the first. Rows that repeat count as one document in that order and get a row of the result each. A
    single document follows itself. Null texts are empty. An empty table gives no rows. Other columns are ignored.

    The order is found on keys alone. A text is shuffled once with its sketch, and once more as the part that the
    document before it takes.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit("null"))
    rows = docs.select(F.col(doc_id).alias("__id"), body.alias("__text"), F.xxhash64(key, body).alias("__h"), key.alias("__key"))
    ids = rows.groupBy("__id", "__key", "__h").agg(F.first(F.length("__text")).alias("__n"))
    ranked = numbered(ids, "__id", "__h", into="__rank", name="order")
    total = ranked.count()
    take, next_rank = F.floor(F.col("__n") / 2).cast("int"), (F.col("__rank") + 1) % max(total, 1)
    after = ranked.select(F.col("__key").alias("__to"), F.col("__h").alias("__to_h"), take.alias("__take"), next_rank.alias("__rank"))
    links = ranked.select("__key", "__h", "__rank").join(after, "__rank").drop("__rank")

    # Both joins read the same columns of this, so that the texts are shuffled once and the exchange is used again.
    sketched = rows.select("__key", "__h", "__text", sketch(F.col("__text"), k, shingle).alias("__own"))
    first = F.row_number().over(Window.partitionBy("__key", "__h").orderBy("__h"))
    heads = sketched.join(links, ["__key", "__h"]).withColumn("__nth", first).filter(F.col("__nth") == 1)
    head = F.substring(F.col("__text"), F.lit(1), F.col("__take"))
    heads = heads.select(F.col("__to").alias("__key"), F.col("__to_h").alias("__h"), head.alias("__head"), F.col("__own").alias("__next"))
    joined = sketched.join(heads, ["__key", "__h"])
    n = F.length("__text")
    edited = F.concat(F.substring(F.col("__text"), F.lit(1), (n - F.floor(n / 2)).cast("int")), F.col("__head"))
    joined = joined.withColumn("__edited", edited)
    return joined.select(
        F.when(F.col("__key") != "null", F.substring(F.col("__key"), F.lit(2), F.length("__key"))).cast(docs.schema[doc_id].dataType).alias(doc_id),
        n.cast("long").alias("n_chars"),
        F.col("__edited").alias("edited"),
        F.col("__own").alias("sketch"),
        sketch(F.col("__edited"), k, shingle).alias("edited_sketch"),
        F.col("__next").alias("next_sketch"),
    )
