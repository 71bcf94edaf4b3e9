"""Queries that read and write the result dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark.operators import convert as C
from evalspark.operators.publish import publish
from evalspark.operators.regroup import regroup
from evalspark.plans.bindings import (
    EV_SQL,
    MEASUREMENTS_SQL,
    ORDER_RESULTS_SQL,
    ORDER_SUITE_SQL,
    ORDER_SUITES,
    READABLE,
    B1_SQL,
    flat_results,
    ingest_time,
    order_envelopes,
    raw_task_documents,
    stamp_text,
)
from evalspark.plans.registry import query
from evalspark.plans.results import _latest_sql
from evalspark.schemas import flat_schema
from evalspark.session import new_shared_path
from evalspark.sources import facets as FA
from evalspark.sources import raw as RAW
from evalspark.sources import store as ST
from evalspark.sources.shards import read_shards
from evalspark.streaming import convert as SC
from evalspark.streaming import results as SR
from evalspark.streaming import state as SS

# Content of a run as text, and its key.
_PAYLOAD_SQL = f"""
{ORDER_RESULTS_SQL},
parts AS (
  SELECT o_orderkey,
         string_agg('{{"name":"' || name || '","metric":"price","value":' || CAST(val AS VARCHAR) || ',"unit":"usd"'
           || CASE WHEN seconds IS NOT NULL THEN ',"duration_seconds":2.5' ELSE '' END
           || ',"tags":[{{"key":"i","value":"' || CAST(i AS VARCHAR) || '"}},{{"key":"status","value":"' || o_orderstatus || '"}}]}}',
           ',' ORDER BY name) AS results,
         count(*) AS n_rows
  FROM rr GROUP BY o_orderkey
),
keyed AS (
  SELECT o_orderkey, coalesce(n_rows, 0) AS n_rows,
         strftime(o_orderdate, '%Y-%m-%dT%H-%M-%S') || '-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || '-' || {ORDER_SUITE_SQL}
           || '-org-model-' || CAST(o_custkey % 50 AS VARCHAR) || '-' || lower(replace(o_orderpriority, ' ', '-')) AS stem,
         '{{"schema_version":"1","timestamp":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
           || '","git_sha":"' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') || '","trigger":"local","suite":"' || {ORDER_SUITE_SQL}
           || '","model":"Org/Model_' || CAST(o_custkey % 50 AS VARCHAR) || '.' || o_orderpriority || '"'
           || CASE WHEN o_orderkey % 2 = 0 THEN ',"model_revision":"rev"' ELSE '' END
           || CASE WHEN o_orderkey % 3 = 0 THEN ',"seed":' || CAST(o_orderkey AS VARCHAR) ELSE '' END
           || ',"os":"os-1","chip":"chip-1","memory_gb":' || CAST(o_orderkey % 9 AS VARCHAR)
           || ',"results":[' || coalesce(results, '') || ']}}' AS payload
  FROM orders LEFT JOIN parts USING (o_orderkey)
)"""
_COPIES = 4
_KEY_SQL = "'data/run-' || stem || '-' || left(sha256(payload), 8) || '.parquet'"


@query("s5_shard_key", f"WITH {_PAYLOAD_SQL} SELECT o_orderkey, {_KEY_SQL} AS shard_key FROM keyed")
def s5_shard_key(spark, sf_dir):
    return ST.with_shard_key(order_envelopes(spark, sf_dir)).select("o_orderkey", "shard_key")


@query(
    "s6_publish_plan",
    f"""WITH {_PAYLOAD_SQL} SELECT o_orderkey, {_KEY_SQL} AS shard_key, n_rows, CAST(strlen(payload) AS BIGINT) AS payload_bytes
        FROM keyed""",
)
def s6_publish_plan(spark, sf_dir):
    return ST.publish_plan(order_envelopes(spark, sf_dir), ["o_orderkey"])


_STORED_SQL = f"""WITH {ORDER_RESULTS_SQL}
SELECT lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS git_sha, {ORDER_SUITE_SQL} AS suite, name, val AS value,
       seconds AS duration_seconds, o_orderstatus AS status, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS BIGINT) AS seed,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS ts_text
FROM rr"""


def _stored(spark, path):
    rows = read_shards(spark, path, flat_schema())
    return rows.select(
        "git_sha", "suite", "name", "value", "duration_seconds", F.col("tags")["status"].alias("status"), "seed",
        stamp_text().alias("ts_text"),
    )


@query("s4_write_results", _STORED_SQL)
def s4_write_results(spark, sf_dir):
    """Flat rows of all runs written by suite, and read back."""
    path = new_shared_path(spark, "results")
    good, _ = ST.split_empty(order_envelopes(spark, sf_dir), ["o_orderkey"])
    ST.write_results(ST.publishable_rows(good), path)
    return _stored(spark, path)


@query(
    "s4_write_results_rejects",
    f"SELECT o_orderkey, '{ST.NO_ROWS}' AS reason FROM orders WHERE o_orderkey % 4 = 0",
)
def s4_write_results_rejects(spark, sf_dir):
    return ST.split_empty(order_envelopes(spark, sf_dir), ["o_orderkey"])[1]


@query("s7_append_new", _STORED_SQL)
def s7_append_new(spark, sf_dir):
    """Some runs are published, then all of them twice over: every run is stored once."""
    path = new_shared_path(spark, "store")
    runs = order_envelopes(spark, sf_dir)
    ST.append_new(runs.where("suite = 'coding'"), path)
    ST.append_new(runs.unionByName(runs), path)
    return _stored(spark, path)


@query(
    "s7_append_new_colliding_keys",
    f"""WITH {_PAYLOAD_SQL}, c AS (SELECT unnest(range({_COPIES})) AS copy, n_rows FROM keyed WHERE n_rows > 0)
        SELECT copy, count(*) AS n_runs, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM c GROUP BY copy""",
)
def s7_append_new_colliding_keys(spark, sf_dir):
    """Runs that share the name of their shard but not their content are all stored: the name is made equal here."""
    path = new_shared_path(spark, "colliding")
    runs = order_envelopes(spark, sf_dir).where("size(results) > 0")
    copies = runs.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(_COPIES - 1))))
    copies = copies.withColumn("model_revision", F.col("copy").cast("string"))
    one_name = ST.new_runs(copies, ST.read_keys(spark, path)).withColumn("shard_key", F.lit("data/run-of-one-name.parquet"))
    ST.write_results(ST.flatten(one_name, ["shard_key", "content_sha"]).withColumn("timestamp", F.to_timestamp("timestamp")), path)
    stored = read_shards(spark, path, flat_schema())
    per_copy = stored.groupBy(F.col("model_revision").cast("bigint").alias("copy"))
    return per_copy.agg(F.countDistinct("content_sha").alias("n_runs"), F.count(F.lit(1)).alias("n_rows"))


@query("s7_append_new_compacted", _STORED_SQL)
def s7_append_new_compacted(spark, sf_dir):
    """A store of several batches, one of them stored twice over by two publishers at once, written anew with each run once."""
    path = new_shared_path(spark, "store")
    runs = order_envelopes(spark, sf_dir)
    ST.append_new(runs.where("suite = 'coding'"), path, "first")
    ST.write_results(ST.publishable_rows(runs.where("suite = 'coding' AND size(results) > 0")), path, "second")
    ST.write_keys(spark, path, "second")
    ST.append_new(runs, path, "third")
    ST.compact(spark, path, f"{path}-compacted")
    return _stored(spark, f"{path}-compacted")


@query("s7_append_after_crash", _STORED_SQL)
def s7_append_after_crash(spark, sf_dir):
    """Drivers are lost after the rows of a batch, and after its keys; what they left does not count, and every run is stored
    once when the batches are made again, one of them under its old name."""
    path = new_shared_path(spark, "store")
    runs = order_envelopes(spark, sf_dir)
    ST.append_new(runs.where("suite = 'coding'"), path)
    rows = ST.publishable_rows(ST.split_empty(runs, ["o_orderkey"])[0])
    ST.write_rows(rows, path, "lost-after-rows")
    ST.write_rows(rows, path, "lost-after-keys")
    ST.write_keys(spark, path, "lost-after-keys")
    ST.append_new(runs.where("suite <> 'knowledge'"), path, "lost-after-keys")
    ST.append_new(runs, path)
    return _stored(spark, path)


@query("s7_compact_tiers", _STORED_SQL)
def s7_compact_tiers(spark, sf_dir):
    """A batch for every suite, then all runs once more by a publisher that did not see them, merged by size classes."""
    path = new_shared_path(spark, "store")
    runs = order_envelopes(spark, sf_dir)
    for suite in ORDER_SUITES:
        ST.append_new(runs.where(F.col("suite") == suite), path, f"of-{suite}")
    ST.write_results(ST.publishable_rows(runs), path, "unaware")
    ST.compact_tiers(spark, path, fanout=2)
    return _stored(spark, path)


def _two_batches(spark, sf_dir):
    path = new_shared_path(spark, "store")
    runs = order_envelopes(spark, sf_dir)
    ST.append_new(runs.where("suite = 'coding'"), path)
    ST.append_new(runs, path)
    return path


@query(
    "c14_regroup_envelopes",
    f"""WITH {_PAYLOAD_SQL} SELECT o_orderkey, sha256(payload) AS content_sha, true AS verified, n_rows AS n_results,
          strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS timestamp FROM keyed JOIN orders USING (o_orderkey) WHERE n_rows > 0""",
)
def c14_regroup_envelopes(spark, sf_dir):
    """Envelopes flattened, stored, and put together again: the same content under the same key."""
    path = _two_batches(spark, sf_dir)
    runs = regroup(read_shards(spark, path, flat_schema()))
    found = F.sha2(ST.canonical_payload(), 256)
    return runs.select(F.col("git_sha").cast("bigint").alias("o_orderkey"), found.alias("content_sha"), "verified", "n_results", "timestamp")


def _maintained(spark, sf_dir):
    """A state that two starts of its stream have brought up to date with a store of several batches, one of them merged."""
    path, state = _two_batches(spark, sf_dir), new_shared_path(spark, "state")
    for _ in range(2):
        stream = SS.start_state(spark, path, state, f"{state}-checkpoint", once=True, every=2, maxFilesPerTrigger="1")
        stream.awaitTermination()
        ST.compact_tiers(spark, path, fanout=2)
    return state


_NEWEST_ORDER_SQL = f"""{ORDER_RESULTS_SQL}, n AS (
  SELECT 'Org/Model_' || CAST(o_custkey % 50 AS VARCHAR) || '.' || o_orderpriority AS model, name, val AS value,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS ts_text, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey % 50, o_orderpriority, name ORDER BY o_orderdate DESC, o_orderkey DESC) AS r,
         row_number() OVER (PARTITION BY o_custkey % 50, o_orderpriority, name
           ORDER BY CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey DESC) AS rs
  FROM rr WHERE {ORDER_SUITE_SQL} = 'coding')"""


@query(
    "q4_leaderboard_maintained",
    f"WITH {_NEWEST_ORDER_SQL} SELECT model, model AS label, value, ts_text FROM n WHERE r = 1 AND name = 'line_1'",
)
def q4_leaderboard_maintained(spark, sf_dir):
    """A leaderboard from the maintained state: snapshot and tail, no row of the store."""
    board = SS.leaderboard(spark, _maintained(spark, sf_dir), "coding", "line_1", "price")
    return board.select("model", "label", "value", stamp_text().alias("ts_text"))


@query(
    "q8_latest_maintained",
    f"""WITH {_NEWEST_ORDER_SQL} SELECT model, name, max(CASE WHEN r = 1 THEN value END) AS value, max(CASE WHEN r = 1 THEN ts_text END) AS ts_text,
          CAST(max(CASE WHEN rs = 1 AND o_orderkey % 3 = 0 THEN o_orderkey END) AS BIGINT) AS seed FROM n GROUP BY model, name""",
)
def q8_latest_maintained(spark, sf_dir):
    """Newest values per model and task from the maintained state, each column its own newest."""
    newest = SS.latest_by_model_task(spark, _maintained(spark, sf_dir), "coding", "price")
    return newest.select("model", "name", "value", stamp_text().alias("ts_text"), "seed")


@query(
    "q11_facets_index",
    f"""WITH {ORDER_RESULTS_SQL}, v AS (
          SELECT {ORDER_SUITE_SQL} AS suite, name, 'price' AS metric, 'Org/Model_' || CAST(o_custkey % 50 AS VARCHAR) || '.' || o_orderpriority AS model
          FROM rr)
        SELECT DISTINCT facet, value FROM (
          SELECT unnest(['suite', 'name', 'metric', 'model']) AS facet, unnest([suite, name, metric, model]) AS value FROM v)
        ORDER BY facet, value""",
)
def q11_facets_index(spark, sf_dir):
    """Facets of a store from its index: no row of it is read."""
    return FA.facets(FA.read_facets(spark, _two_batches(spark, sf_dir)))


@query(
    "q14_stats_index",
    f"""WITH {ORDER_RESULTS_SQL} SELECT count(*) AS n_rows, count(DISTINCT o_custkey % 50 || o_orderpriority) AS n_models FROM rr""",
)
def q14_stats_index(spark, sf_dir):
    """Rows and models of a store after a merge of its batches, from the index."""
    path = _two_batches(spark, sf_dir)
    ST.compact_tiers(spark, path, fanout=2)
    return FA.dataset_stats(FA.read_facets(spark, path))


@query("f2_tag_keys_index", "SELECT unnest(['i', 'status']) AS key FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey % 4 > 0) WHERE n > 0")
def f2_tag_keys_index(spark, sf_dir):
    return FA.tag_keys(FA.read_facets(spark, _two_batches(spark, sf_dir)))


@query(
    "q12_pivot_names_index",
    f"WITH {ORDER_RESULTS_SQL} SELECT DISTINCT name FROM rr WHERE {ORDER_SUITE_SQL} = 'coding' ORDER BY name",
)
def q12_pivot_names_index(spark, sf_dir):
    """The columns of a pivot of one suite and metric."""
    return FA.pivot_names(FA.read_facets(spark, _two_batches(spark, sf_dir)), "coding", "price")


@query(
    "s4_write_results_odd_times",
    "SELECT CASE o_orderkey % 8 WHEN 4 THEN 'refused' ELSE 'stored' END AS fate, count(*) AS n FROM orders GROUP BY 1",
)
def s4_write_results_odd_times(spark, sf_dir):
    """Times in lower case and with an offset are stored, one that is no time is refused, and the others are not lost."""
    path = new_shared_path(spark, "times")
    runs = order_envelopes(spark, sf_dir)
    stamp = F.col("timestamp")
    odd = F.when(F.col("o_orderkey") % 8 == 4, "yesterday at noon").when(F.col("o_orderkey") % 4 == 1, F.lower(stamp))
    odd = odd.when(F.col("o_orderkey") % 4 == 2, F.replace(stamp, F.lit("Z"), F.lit("+02:00"))).otherwise(stamp)
    one = F.expr("named_struct('name', 'n', 'metric', 'm', 'value', 1.0D, 'unit', 'u', 'duration_seconds', CAST(NULL AS DOUBLE), 'tags', CAST(map() AS map<string,string>))")
    runs = runs.withColumns({"timestamp": odd, "results": F.array(one)})
    good, bad = ST.split_empty(runs, ["o_orderkey"])
    ST.write_results(ST.publishable_rows(good), path)
    stored = read_shards(spark, path, flat_schema()).where("timestamp IS NOT NULL").select(F.lit("stored").alias("fate"))
    refused = bad.where(F.col("reason") == ST.NO_INSTANT).select(F.lit("refused").alias("fate"))
    return stored.unionByName(refused).groupBy("fate").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s2_read_shards",
    f"""WITH {B1_SQL} SELECT shard_key, ts_text, model, model_short, value, k,
          CAST(CASE WHEN metric <> 'accuracy' AND event_id % 2 = 0 THEN event_id END AS BIGINT) AS seed FROM b1""",
)
def s2_read_shards(spark, sf_dir):
    """Shards with different columns, times as text, united by name."""
    path = new_shared_path(spark, "shards")
    rows = flat_results(spark, sf_dir)
    rows = rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    rows.where("metric = 'accuracy'").drop("seed", "duration_seconds").write.mode("append").parquet(path)
    rows.where("metric <> 'accuracy'").write.mode("append").parquet(path)
    united = read_shards(spark, path, flat_schema(timestamp_type="STRING"))
    return united.select(
        "shard_key", stamp_text().alias("ts_text"), "model", "model_short", "value", F.col("tags")["k"].alias("k"), "seed"
    )


@query(
    "s1_read_raw",
    f"""WITH {EV_SQL} SELECT CASE WHEN id % 13 = 12 THEN 'not valid JSON' WHEN id % 4 = 0 THEN '(none)' WHEN id % 4 = 1 THEN ''
          ELSE 'named-' || CAST(u % 7 AS VARCHAR) END AS found, count(*) AS n FROM ev GROUP BY 1""",
)
def s1_read_raw(spark, sf_dir):
    """Documents as text files, one per line, and what was found in them."""
    path = new_shared_path(spark, "raw")
    raw_task_documents(spark, sf_dir).select("raw").write.text(path)
    docs, rejects = RAW.read_raw(spark, path, lines=True)
    name = F.coalesce(F.try_variant_get("doc", "$.model_name", "string"), F.lit("(none)"))
    found = docs.select(name.alias("found")).unionByName(rejects.select(F.col("reason").alias("found")))
    return found.groupBy("found").agg(F.count(F.lit(1)).alias("n"))


_EVERY = "suite, name, metric, model"


@query(
    "s8_stream_results",
    f"WITH {B1_SQL}, {_latest_sql(_EVERY, 'model IS NOT NULL')} SELECT {_EVERY}, value, ts_text FROM newest",
)
def s8_stream_results(spark, sf_dir):
    """Shards arrive in several batches; the maintained latest scores equal the batch query's."""
    shards, state = new_shared_path(spark, "arriving"), new_shared_path(spark, "latest")
    rows = flat_results(spark, sf_dir)
    for metrics in ("metric = 'accuracy'", "metric <> 'accuracy'"):
        rows.where(metrics).write.mode("append").parquet(shards)
    stream = SR.stream_results(spark, shards, flat_schema(), maxFilesPerTrigger="1")
    SR.start_latest(stream, state, state + "-checkpoint", once=True).awaitTermination()
    SR.snapshot_latest(spark, state)
    return SR.read_latest(spark, state).select("suite", "name", "metric", "model", "value", stamp_text().alias("ts_text"))


def _context(docs):
    """Runs in the stream state nothing but their text; the revision is a digest of it."""
    return docs.withColumns(
        {
            "git_sha": F.left(F.sha1("raw"), F.lit(16)),
            "suite": F.lit("reasoning"),
            "system": F.expr("named_struct('os', 'os-1', 'chip', 'chip-1', 'memory_gb', 128L)"),
        }
    )


def _numbered_context(docs):
    return _context(docs).withColumn("git_sha", F.lpad(F.col("id").cast("string"), 8, "0"))


def _convert_stream(spark, sf_dir, base=None, checkpoint="checkpoint"):
    base = base or new_shared_path(spark, "convert")
    docs = raw_task_documents(spark, sf_dir)
    numbered = docs.select(F.concat(F.lit('{"run": '), F.col("id").cast("string"), F.lit(", "), F.expr("substring(raw, 2)")))
    numbered.write.mode("ignore").option("compression", "gzip").text(f"{base}/raw")
    arriving = SC.stream_raw(spark, f"{base}/raw", lines=True)
    query_ = SC.start_convert(
        arriving, "lm-eval", ["path"], f"{base}/out", f"{base}/rejects", f"{base}/{checkpoint}", _context, ingest_time(), once=True
    )
    query_.awaitTermination()
    return f"{base}/out", f"{base}/rejects"


@query(
    "s9_stream_convert",
    f"""WITH {EV_SQL}, {MEASUREMENTS_SQL} SELECT task AS name, metric, val AS value, unit,
          CAST(CASE WHEN id % 3 = 1 THEN k END AS BIGINT) AS seed FROM mm WHERE {READABLE}""",
)
def s9_stream_convert(spark, sf_dir):
    """Raw documents as a stream of files to stored rows."""
    out, _ = _convert_stream(spark, sf_dir)
    return read_shards(spark, out, flat_schema()).select("name", "metric", "value", "unit", "seed")


@query(
    "s9_two_streams",
    f"""WITH {EV_SQL}, {MEASUREMENTS_SQL} SELECT 'stream' AS origin, task AS name, metric, count(*) AS n FROM mm WHERE {READABLE} GROUP BY ALL
        UNION ALL SELECT 'batch', task, metric, count(*) FROM mm WHERE {READABLE} GROUP BY ALL""",
)
def s9_two_streams(spark, sf_dir):
    """A stream, a second one with a checkpoint of its own and a batch on one store: nothing is overwritten or doubled."""
    base = new_shared_path(spark, "convert")
    _convert_stream(spark, sf_dir, base, "first")
    _convert_stream(spark, sf_dir, base, "second")
    docs = raw_task_documents(spark, sf_dir).select("id", "raw")
    publish(docs, "lm-eval", ["id"], f"{base}/out", f"{base}/rejects", _numbered_context, ingest_time())
    rows = read_shards(spark, f"{base}/out", flat_schema())
    origin = F.when(F.length("git_sha") == 8, "batch").otherwise("stream")
    return rows.groupBy(origin.alias("origin"), "name", "metric").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s1_read_loose_json",
    """SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'not finite' ELSE CAST(event_id AS VARCHAR) END AS last, event_id % 2 = 0 AS has_nan
       FROM events""",
)
def s1_read_loose_json(spark, sf_dir):
    """Documents with repeated keys, of which the last counts, and with numbers that are not finite."""
    raw = F.concat(
        F.lit('{"v": -1, "v": '), F.when(F.col("event_id") % 3 == 2, "-Infinity").otherwise(F.col("event_id").cast("string")),
        F.lit(', "e": '), F.when(F.col("event_id") % 2 == 0, "NaN").otherwise("1"), F.lit("}"),
    )
    docs = RAW.parse_documents(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", raw.alias("raw")))
    v, e = F.try_variant_get("doc", "$.v", "double"), F.try_variant_get("doc", "$.e", "double")
    last = F.when(F.abs(v) == float("inf"), "not finite").otherwise(v.cast("bigint").cast("string"))
    return docs.select("event_id", last.alias("last"), F.isnan(e).alias("has_nan"))


# Forms of a text, by event, with the event's number for #, and whether each is one JSON document.
_FORMS = [
    ('{"v": #}', True),
    ('{"v": #}{"v": 0}', False),
    ('{"v": #} xyz', False),
    ('{"v": #} ,', False),
    ("{'v': #}", False),
    ('{"v": #, "w": +INF}', False),
    (' {"v": #}\n', True),
    ('{"v": #}] "x"', False),
    ('{"v": #}\n<<<<<<< HEAD', False),
    ('{"v": #, "w": "INF \\"+Infinity"}', True),
    ('{"v": #}, {"v": 1}', False),
    ('{"v": 1, "v": #, "w": [NaN, -Infinity]}', True),
    ('{"v": #', False),
    ('', False),
]


@query(
    "s1_one_document",
    f"""SELECT event_id, event_id % {len(_FORMS)} IN ({", ".join(str(i) for i, (_, good) in enumerate(_FORMS) if good)}) AS readable,
          CASE WHEN event_id % {len(_FORMS)} IN ({", ".join(str(i) for i, (_, good) in enumerate(_FORMS) if good)}) THEN event_id END AS v
        FROM events""",
)
def s1_one_document(spark, sf_dir):
    """Texts that are one JSON document, and texts that hold one and more, or less."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    forms = F.array(*[F.concat(*_around(form)) for form, _ in _FORMS])
    docs = RAW.parse_documents(events.select("event_id", F.get(forms, F.col("event_id") % len(_FORMS)).alias("raw")))
    return docs.select("event_id", F.col("doc").isNotNull().alias("readable"), F.try_variant_get("doc", "$.v", "bigint").alias("v"))


def _around(form: str) -> list:
    before, *after = form.split("#")
    return [F.lit(before), *[x for a in after for x in (F.col("event_id").cast("string"), F.lit(a))]]


def _batch(spark, sf_dir):
    docs = raw_task_documents(spark, sf_dir).select("id", "raw")
    return docs, new_shared_path(spark, "published")


@query(
    "publish_batch",
    f"""WITH {EV_SQL}, {MEASUREMENTS_SQL} SELECT lpad(CAST(id AS VARCHAR), 8, '0') AS git_sha, task AS name, metric,
          val AS value, unit FROM mm WHERE {READABLE}""",
)
def publish_batch(spark, sf_dir):
    """The whole way in one batch: parse, convert, validate, flatten, append; then read what was stored."""
    docs, base = _batch(spark, sf_dir)
    publish(docs, "lm-eval", ["id"], f"{base}/out", f"{base}/rejects", _numbered_context, ingest_time())
    return read_shards(spark, f"{base}/out", flat_schema()).select("git_sha", "name", "metric", "value", "unit")


@query(
    "publish_dry_run",
    f"""WITH {EV_SQL}, {MEASUREMENTS_SQL} SELECT id, count(*) AS n_rows FROM mm WHERE {READABLE} GROUP BY id""",
)
def publish_dry_run(spark, sf_dir):
    docs, base = _batch(spark, sf_dir)
    plan = publish(docs, "lm-eval", ["id"], f"{base}/out", f"{base}/rejects", _numbered_context, ingest_time(), dry_run=True)
    return plan.select("id", "n_rows")


@query(
    "s9_stream_convert_rejects",
    f"""WITH {EV_SQL} SELECT CASE WHEN id % 13 = 12 THEN '{C.NOT_JSON}' WHEN id % 23 = 7 THEN 'config is not an object'
          ELSE '{ST.NO_ROWS}' END AS reason, count(*) AS n
        FROM ev WHERE id % 13 = 12 OR id % 23 = 7 OR id % 17 = 0 GROUP BY 1""",
)
def s9_stream_convert_rejects(spark, sf_dir):
    _, rejects = _convert_stream(spark, sf_dir)
    rows = spark.read.schema("path STRING, reasons ARRAY<STRING>").parquet(rejects)
    return rows.groupBy(F.array_join("reasons", "; ").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
