"""Report analytics: latency, concurrency, streaming, cost, gaps to a baseline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rank error of the quantile sketch is at most n / SKETCH; the bracket is ten times as wide.
SKETCH = 10_000
MARGIN = 10 / SKETCH
# Small groups need wider brackets to have two values on either side, the smallest are taken whole.
MARGINS = [MARGIN, 0.02, 0.2, 1.0]
# Ranges that a bracket is cut into, so that the values of a hot key are put in order by many tasks.
RANGES = 1024
# Copies of the brackets that a hot key's rows are dealt to.
SALTS = 32


# Greatest finite double. A sketch is given it in place of what lies beyond all numbers.
_GREATEST = 1.7976931348623157e308


def _finite(v: Column, floating: bool) -> Column:
    """A value as a sketch and arithmetic can take it: -Infinity is the least number, Infinity and NaN the greatest."""
    if not floating:
        return v
    near = F.when(F.isnan(v), _GREATEST).otherwise(F.greatest(F.lit(-_GREATEST), F.least(F.lit(_GREATEST), v)))
    return F.when(v.isNotNull(), near)  # the least of a number and NULL is the number


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, at: dict[str, float], also: dict[str, Column] | None = None
) -> DataFrame:
    """Exact quantiles per key without holding a key's values in one task; ``also`` are aggregates of the same pass.

    ``at`` names the quantiles, say ``{"median": 0.5, "p99": 0.99}``. All are found together, each between the two values next
    to the rank ``p * (n - 1)``. Values are in total order: -Infinity, numbers, Infinity, NaN; NULL is no value. A group of
    failed measurements has a quantile like any other; it does not end the report.

    The built-in functions keep every distinct value of a group in the memory of one task. Here a sketch brackets each
    rank in a first pass. In the second the rows below a bracket are only counted, and just the values inside it
    (about 0.2 % of a large group, merged by value) are put in order, range by range: a range counts its own values, and
    the ranges before it are sums, at most ``RANGES`` for a key. A bracket that missed would raise an error, not give a
    wrong quantile.
    """
    names, shares = list(at), list(at.values())
    if not names or not all(0 <= p <= 1 for p in shares):
        raise ValueError("quantiles lie between 0 and 1")
    floating = df.schema[value].dataType.typeName() in ("double", "float")
    v, n, b = F.col("_v"), F.col("_n"), F.col("_b")
    edges = [min(1.0, max(0.0, p + d)) for p in shares for m in MARGINS for d in (-m, m)]
    bracket = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        F.count(value).alias("_n"),
        F.percentile_approx(_finite(F.col(value), floating), edges, SKETCH).alias("_q"),
        F.struct(F.lit(0).alias("_"), *[c.alias(name) for name, c in (also or {}).items()]).alias("_also"),
    )
    # A key with a third of all rows must not meet its bracket in one task. The brackets are few and copied; the rows go
    # to the copy of the task that read them, whose number stays the same when it is run again.
    copies = bracket.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = df.select(*keys, F.col(value).alias("_v"), (F.spark_partition_id() % SALTS).alias("_salt"))
    meet = reduce(lambda a, c: a & c, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], F.col("_salt") == F.col("_copy"))
    q = F.col("_q")

    def edge(i: int, side: int) -> Column:
        """Of the brackets around a quantile the narrowest that reaches two ranks beyond it."""
        at = [q[2 * (len(MARGINS) * i + k) + side] for k in range(len(MARGINS))]
        chosen = at[-1]
        for margin, value_ in list(zip(MARGINS, at))[-2::-1]:
            chosen = F.when(n * margin >= 2, value_).otherwise(chosen)
        return chosen

    each = F.array(*[F.struct(F.lit(i).alias("p"), edge(i, 0).alias("a"), edge(i, 1).alias("b")) for i in range(len(names))])
    s = _finite(v, floating)
    placed = rows.join(copies, meet).withColumn("_b", F.explode(each)).where((s <= b["b"]) | (n == 0))
    merged = placed.groupBy(*keys, b["p"].alias("_p"), F.when(s >= b["a"], v).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"), F.first("_also").alias("_also"), F.first("_b").alias("_b")
    )
    # The rows below the bracket are the NULL value, a range of its own before all others. Halves cannot overflow.
    share = F.floor((s / 2 - b["a"] / 2) / (b["b"] / 2 - b["a"] / 2) * RANGES)
    place = F.when(v.isNull(), -1).when(b["b"] > b["a"], F.least(share, F.lit(RANGES - 1))).otherwise(0)
    merged = merged.withColumn("_range", place.cast("int")).drop("_b")
    groups = [*keys, "_p"]
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = merged.groupBy(*groups, "_range").agg(F.sum("_c").alias("_rows"))
    ranges = ranges.select(
        *[F.col(k).alias(f"_of_{k}") for k in groups],
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*groups, "_range").orderBy(v)
    same = reduce(lambda a, c: a & c, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in groups], F.col("_range") == F.col("_of"))
    ranked = merged.withColumn("_in", F.sum("_c").over(inside)).join(ranges, same)
    ranked = ranked.withColumn("_upto", F.col("_before") + F.col("_in"))

    def ranked_at(i: int, rank: Column) -> Column:
        here = (F.col("_p") == i) & (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_c") < rank)
        return F.max(F.when(here, v))

    place_of = {name: p * (n - 1) for name, p in at.items()}
    ends = [
        F.struct(ranked_at(i, F.floor(place_of[name]) + 1).alias("lo"), ranked_at(i, F.ceil(place_of[name]) + 1).alias("hi")).alias(f"_at_{i}")
        for i, name in enumerate(names)
    ]
    found = ranked.groupBy(*keys).agg(*ends, F.first("_n").alias("_n"), F.first("_also").alias("_also"))
    missed = F.raise_error(F.lit("quantile outside its bracket")).cast("double")
    out = []
    for i, name in enumerate(names):
        lo, hi = F.col(f"_at_{i}.lo"), F.col(f"_at_{i}.hi")
        between = _between(lo.cast("double"), hi.cast("double"), place_of[name] - F.floor(place_of[name]))
        out.append(F.when(n == 0, F.lit(None)).when(lo.isNull() | hi.isNull(), missed).otherwise(between).alias(name))
    return found.select(*keys, *[F.col(f"_also.{name}") for name in also or {}], *out)


def _between(lo: Column, hi: Column, part: Column) -> Column:
    """The value a part of the way from ``lo`` to ``hi``. Half way is the mean; beyond the numbers sums of parts decide."""
    straight = F.when(part == 0.5, (lo + hi) / 2).otherwise(lo + (hi - lo) * part)
    return F.when((part == 0) | (lo == hi), lo).when(F.abs(straight) < float("inf"), straight).otherwise(lo * (1 - part) + hi * part)


def exact_median(df: DataFrame, keys: list[str], value: str, also: dict[str, Column] | None = None) -> DataFrame:
    """The exact median per key, see :func:`exact_quantiles`."""
    return exact_quantiles(df, keys, value, {"median": 0.5}, also)


def latency_summary(
    df: DataFrame, keys: list[str], seconds: str = "seconds", correct: str = "correct", quantiles: dict[str, float] | None = None
) -> DataFrame:
    """Samples, mean, minimum, maximum and correct answers per key, the median, and other ``quantiles`` by name."""
    simple = {
        "n": F.count(F.lit(1)),
        "mean": F.avg(seconds),
        "min": F.min(seconds),
        "max": F.max(seconds),
        "n_correct": F.count_if(F.col(correct)),
    }
    return exact_quantiles(df, keys, seconds, {"median": 0.5, **(quantiles or {})}, simple)


def paired_overhead(df: DataFrame, keys: list[str], base: str, other: str, sample: str = "sample") -> DataFrame:
    """Difference of two arms: mean over paired samples, and of the arms' own means.

    The arms of a sample are brought together by conditional aggregation, not by a join of the table with itself.
    """
    seconds = F.col("seconds")

    def arm(name: str) -> Column:
        return F.avg(F.when(F.col("arm") == name, seconds))

    pairs = df.where(F.col("arm").isin(base, other)).groupBy(*keys, sample).agg(
        arm(base).alias("_base"), arm(other).alias("_other")
    )
    return pairs.groupBy(*keys).agg(
        F.count(F.col("_other") - F.col("_base")).alias("n_pairs"),
        F.avg(F.col("_other") - F.col("_base")).alias("paired_diff"),
        (F.avg("_other") - F.avg("_base")).alias("diff_of_means"),
    )


def concurrency_speedup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Wall time of a batch (last end minus first start) and how much shorter it is than its requests in a row.

    ``started`` and ``ended`` are seconds.
    """
    wall = F.max("ended") - F.min("started")
    total = F.sum(F.col("ended") - F.col("started"))
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        wall.alias("wall"),
        total.alias("sequential"),
        (total / F.nullif(wall, F.lit(0.0))).alias("speedup"),
    )


def stream_timing(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Per streamed request: chunks, time to the first, total time, generation alone, chunks per second after it.

    ``at`` is seconds since the request was sent.
    """
    timed = chunks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("chunks"), F.min("at").alias("first_chunk"), F.max("at").alias("total")
    )
    generation = F.col("total") - F.col("first_chunk")
    return timed.withColumn("generation", generation).withColumn(
        "rate", (F.col("chunks") - 1) / F.nullif("generation", F.lit(0.0))
    )


def _with_baseline(df: DataFrame, keys: list[str], baseline: str | Column, value: str) -> DataFrame:
    """Add ``_base``: the baseline model's value for the same keys, by equi-join on them.

    Without keys there is one value for all rows, from an aggregation without groups.
    """
    base = df.where(F.col("model") == baseline).groupBy(*keys).agg(F.max(value).alias("_base"))
    if not keys:
        return df.withColumn("_base", base.scalar())
    return df.join(base, keys, "left")


def per_example_cost(runs: DataFrame, keys: list[str], baseline: str | Column) -> DataFrame:
    """Seconds per example of each model, and how many times faster it is than the baseline.

    ``runs`` has ``model, total_seconds, examples``.
    """
    cost = runs.groupBy(*keys, "model").agg(
        F.sum("total_seconds").alias("total_seconds"), F.sum("examples").alias("examples")
    )
    cost = cost.withColumn("per_example", F.col("total_seconds") / F.nullif("examples", F.lit(0)))
    ratio = F.col("_base") / F.nullif("per_example", F.lit(0.0))
    return _with_baseline(cost, keys, baseline, "per_example").withColumn("speed_ratio", ratio).drop("_base")


def score_gap(scores: DataFrame, keys: list[str], baseline: str | Column) -> DataFrame:
    """Valid scores and their distance to the baseline model's. Needs ``model, score, valid``."""
    valid = scores.where("valid")
    gap = F.col("score") - F.col("_base")
    return _with_baseline(valid, keys, baseline, "score").withColumn("gap", gap).drop("_base", "valid")


def budget_flag(runs: DataFrame, timeout: float = 300.0) -> DataFrame:
    """Worst seconds per example under a token budget, and whether the budget explains a score of 0.

    Needs ``max_gen_toks, decode_rate, per_example, score``. A run is flagged when it scored 0 and its examples took
    as long as the whole budget takes to decode.
    """
    worst = F.col("max_gen_toks") / F.nullif("decode_rate", F.lit(0.0))
    return runs.withColumn("worst_per_example", worst).withColumns(
        {
            "budget_exhausted": (F.col("score") == 0) & (F.col("per_example") >= F.col("worst_per_example")),
            "over_timeout": F.col("worst_per_example") > timeout,
        }
    )


def top_models(df: DataFrame, n: int, by: str = "downloads") -> DataFrame:
    """The ``n`` models with the largest ``by``; each task keeps no more than ``n`` rows."""
    return df.orderBy(F.col(by).desc_nulls_last(), "model").limit(n)
