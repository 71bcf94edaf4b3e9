"""Report queries over timings and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark.operators import reports as R
from evalspark.plans.bindings import table
from evalspark.plans.registry import query


def timings(spark, sf_dir):
    """One request per event: two arms that alternate, batches by user and day."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type",
        "user_id",
        "CAST(ts AS DATE) AS day",
        "IF(event_id % 2 = 0, 'direct', 'gateway') AS arm",
        "event_id DIV 2 AS sample",
        "value AS seconds",
        "event_id % 3 = 0 AS correct",
        "unix_micros(CAST(ts AS TIMESTAMP)) / CAST(1000000 AS DOUBLE) AS started",
        "unix_micros(CAST(ts AS TIMESTAMP)) / CAST(1000000 AS DOUBLE) + value AS ended",
    )


@query(
    "r1_latency_summary",
    """SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
         count(*) FILTER (event_id % 3 = 0) AS n_correct, median(value) AS median FROM events GROUP BY event_type""",
)
def r1_latency_summary(spark, sf_dir):
    s = R.latency_summary(timings(spark, sf_dir), ["event_type"])
    return s.withColumn("mean", F.round("mean", 6))


# Every ninth request failed in some way: no number, or none at all.
_ODD = "CASE event_id % 9 WHEN 0 THEN {nan} WHEN 1 THEN {inf} WHEN 2 THEN -{inf} WHEN 3 THEN NULL ELSE {value} END"
_QUANTILES = {"median": 0.5, "p10": 0.1, "p25": 0.25, "p90": 0.9, "p99": 0.99}


def _rank_sql(name: str, p: float) -> str:
    """Between the values ranked next to p * (n - 1), as the ranks of a window tell."""
    at, lo, hi = f"({p} * (n - 1))", f"max(CASE WHEN r = floor({p} * (n - 1)) + 1 THEN v END)", f"max(CASE WHEN r = ceil({p} * (n - 1)) + 1 THEN v END)"
    part = f"({at} - floor({at}))"
    straight = f"CASE WHEN {part} = 0.5 THEN ({lo} + {hi}) / 2 ELSE {lo} + ({hi} - {lo}) * {part} END"
    mixed = f"{lo} * (1 - {part}) + {hi} * {part}"
    return f"CASE WHEN {part} = 0 OR {lo} = {hi} THEN {lo} WHEN isfinite({lo}) AND isfinite({hi}) THEN {straight} ELSE {mixed} END AS {name}"


@query(
    "r1_order_statistics",
    f"""WITH e AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE event_type END AS k,
          {_ODD.format(nan="'NaN'::DOUBLE", inf="'Infinity'::DOUBLE", value="value")} AS v FROM events),
        o AS (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY v) AS r, count(*) OVER (PARTITION BY k) AS n FROM e WHERE v IS NOT NULL),
        a AS (SELECT k, count(*) AS n FROM e GROUP BY k)
        SELECT a.k AS key, a.n AS n, {", ".join(_rank_sql(name, p).replace("(n - 1)", "(o.n - 1)") for name, p in _QUANTILES.items())}
        FROM a LEFT JOIN o ON a.k = o.k GROUP BY a.k, a.n, o.n""",
)
def r1_order_statistics(spark, sf_dir):
    """Several quantiles at once of values that are not all finite, one key with a third of the rows."""
    odd = F.expr(_ODD.format(nan="DOUBLE('NaN')", inf="DOUBLE('Infinity')", value="seconds"))
    key = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("event_type"))
    rows = timings(spark, sf_dir).select(key.alias("key"), odd.alias("v"))
    return R.exact_quantiles(rows, ["key"], "v", _QUANTILES, {"n": F.count(F.lit(1))})


@query(
    "r2_paired_overhead",
    """WITH p AS (SELECT event_id // 2 AS sample, avg(CASE WHEN event_id % 2 = 0 THEN value END) AS a,
         avg(CASE WHEN event_id % 2 = 1 THEN value END) AS b FROM events GROUP BY 1)
       SELECT count(b - a) AS n_pairs, round(avg(b - a), 6) AS paired_diff, round(avg(b) - avg(a), 6) AS diff_of_means FROM p""",
)
def r2_paired_overhead(spark, sf_dir):
    d = R.paired_overhead(timings(spark, sf_dir), [], "direct", "gateway")
    return d.select("n_pairs", F.round("paired_diff", 6).alias("paired_diff"), F.round("diff_of_means", 6).alias("diff_of_means"))


@query(
    "r3_concurrency_speedup",
    """WITH e AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, epoch_us(ts) / CAST(1000000 AS DOUBLE) AS s,
         epoch_us(ts) / CAST(1000000 AS DOUBLE) + value AS t FROM events)
       SELECT user_id, day, count(*) AS n, round(max(t) - min(s), 3) AS wall, round(sum(t - s), 3) AS sequential,
         round(sum(t - s) / nullif(max(t) - min(s), 0), 6) AS speedup FROM e GROUP BY user_id, day""",
)
def r3_concurrency_speedup(spark, sf_dir):
    s = R.concurrency_speedup(timings(spark, sf_dir), ["user_id", "day"])
    return s.select(
        "user_id", F.col("day").cast("string").alias("day"), "n", F.round("wall", 3).alias("wall"),
        F.round("sequential", 3).alias("sequential"), F.round("speedup", 6).alias("speedup"),
    )


@query(
    "r4_stream_timing",
    """WITH c AS (SELECT l_orderkey, l_linenumber * CAST(1.5 AS DOUBLE) + l_discount AS at_s FROM lineitem),
       t AS (SELECT l_orderkey, count(*) AS chunks, min(at_s) AS first_chunk, max(at_s) AS total FROM c GROUP BY l_orderkey)
       SELECT l_orderkey, chunks, first_chunk, total, total - first_chunk AS generation,
         (chunks - 1) / nullif(total - first_chunk, 0) AS rate FROM t""",
)
def r4_stream_timing(spark, sf_dir):
    chunks = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber * CAST(1.5 AS DOUBLE) + l_discount AS at"
    )
    return R.stream_timing(chunks, ["l_orderkey"])


@query(
    "r5_per_example_cost",
    """WITH c AS (SELECT l_returnflag, 'model-' || CAST(l_suppkey % 10 AS VARCHAR) AS model, sum(l_extendedprice) AS total_seconds,
         sum(CAST(l_quantity AS BIGINT)) AS examples FROM lineitem GROUP BY 1, 2),
       p AS (SELECT *, total_seconds / examples AS per_example FROM c)
       SELECT p.l_returnflag, p.model, round(p.total_seconds, 2) AS total_seconds, CAST(p.examples AS BIGINT) AS examples,
         round(p.per_example, 4) AS per_example, round(b.per_example / p.per_example, 8) AS speed_ratio
       FROM p LEFT JOIN p b ON b.l_returnflag = p.l_returnflag AND b.model = 'model-3'""",
)
def r5_per_example_cost(spark, sf_dir):
    runs = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag",
        "concat('model-', l_suppkey % 10) AS model",
        "l_extendedprice AS total_seconds",
        "CAST(l_quantity AS BIGINT) AS examples",
    )
    cost = R.per_example_cost(runs, ["l_returnflag"], "model-3")
    return cost.select(
        "l_returnflag", "model", F.round("total_seconds", 2).alias("total_seconds"), "examples",
        F.round("per_example", 4).alias("per_example"), F.round("speed_ratio", 8).alias("speed_ratio"),
    )


_SCORES = "SELECT lang, source AS model, avg(CAST(quality AS DOUBLE)) AS score, count(*) >= 3 AS valid FROM {o} GROUP BY lang, source"


@query(
    "r6_score_gap",
    f"""WITH o AS (SELECT lang, source, quality FROM labels JOIN documents USING (doc_id)), s AS ({_SCORES.format(o="o")}),
        v AS (SELECT * FROM s WHERE valid), b AS (SELECT lang, score AS base FROM v WHERE model = (SELECT min(source) FROM documents))
        SELECT v.lang, v.model, round(v.score, 8) AS score, round(v.score - base, 8) AS gap FROM v LEFT JOIN b USING (lang)""",
)
def r6_score_gap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("source").alias("model"))
    scores = (
        table(spark, sf_dir, "labels").join(docs, "doc_id").groupBy("lang", "model")
        .agg(F.avg(F.col("quality").cast("double")).alias("score"), (F.count(F.lit(1)) >= 3).alias("valid"))
    )
    gap = R.score_gap(scores, ["lang"], docs.agg(F.min("model")).scalar())
    return gap.select("lang", "model", F.round("score", 8).alias("score"), F.round("gap", 8).alias("gap"))


@query(
    "r7_budget_flag",
    """SELECT l_orderkey, l_linenumber, l_quantity * 100 / nullif(l_discount * 100, 0) AS worst_per_example,
         (l_returnflag = 'R') AND l_quantity * 7 >= l_quantity * 100 / nullif(l_discount * 100, 0) AS budget_exhausted,
         l_quantity * 100 / nullif(l_discount * 100, 0) > 300 AS over_timeout FROM lineitem""",
)
def r7_budget_flag(spark, sf_dir):
    runs = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_quantity * 100 AS max_gen_toks",
        "l_discount * 100 AS decode_rate",
        "l_quantity * 7 AS per_example",
        "IF(l_returnflag = 'R', 0.0D, 0.5D) AS score",
    )
    flags = R.budget_flag(runs)
    return flags.select("l_orderkey", "l_linenumber", "worst_per_example", "budget_exhausted", "over_timeout")


@query(
    "r6_score_gap_of_all",
    """WITH s AS (SELECT source AS model, avg(CAST(quality AS DOUBLE)) AS score FROM labels JOIN documents USING (doc_id) GROUP BY source)
       SELECT model, round(score, 8) AS score, round(score - (SELECT score FROM s WHERE model = 'src1'), 8) AS gap FROM s""",
)
def r6_score_gap_of_all(spark, sf_dir):
    """One table of models without a grouping key."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("model"))
    scores = table(spark, sf_dir, "labels").join(docs, "doc_id").groupBy("model").agg(F.avg(F.col("quality").cast("double")).alias("score"))
    gap = R.score_gap(scores.withColumn("valid", F.lit(True)), [], "src1")
    return gap.select("model", F.round("score", 8).alias("score"), F.round("gap", 8).alias("gap"))


@query("r8_top_models", "SELECT c_name AS model, c_acctbal AS downloads FROM customer ORDER BY c_acctbal DESC, c_name LIMIT 20")
def r8_top_models(spark, sf_dir):
    models = table(spark, sf_dir, "customer").selectExpr("c_name AS model", "c_acctbal AS downloads")
    return R.top_models(models, 20)
