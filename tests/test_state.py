"""The maintained state against a scan of the store."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from evalspark.operators import results as Q
from evalspark.sources import store as ST
from evalspark.sources.shards import read_shards
from evalspark.streaming import state as SS
from test_streaming import flat


def test_state_equals_scan_after_every_arrival(spark, tmp_path):
    path, state = str(tmp_path / "store"), str(tmp_path / "state")
    rows = flat(spark, 400).withColumn("metric", F.when(F.col("content_sha") < "8", "accuracy").otherwise("other"))
    parts = [rows.where((F.conv(F.substring("content_sha", 1, 4), 16, 10).cast("int") % 5) == i) for i in range(5)]

    def arrive(*some):
        for df in some:
            ST.write_results(df, path)
        SS.start_state(spark, path, state, state + "-checkpoint", once=True, every=3, maxFilesPerTrigger="1").awaitTermination()

    def same():
        scan = read_shards(spark, path)
        for metric in ("accuracy", "other", "none"):
            want = Q.leaderboard(scan, "reasoning", "t1", metric).collect()
            assert SS.leaderboard(spark, state, "reasoning", "t1", metric).collect() == want
            newest = Q.latest_by_model_task(Q.select_results(scan, "reasoning", metric=metric))
            got = SS.latest_by_model_task(spark, state, "reasoning", metric)
            shown = ["model", "name", "value", "timestamp", "seed", "shard_key", "model_short", "tags"]
            assert sorted(map(str, got.select(*shown).collect())) == sorted(map(str, newest.select(*shown).collect()))
        one = Q.latest_by_model(Q.select_results(scan, "reasoning", "t0", "accuracy"))
        assert SS.latest_by_model(spark, state, "reasoning", "t0", "accuracy").count() == one.count()

    arrive(parts[0], parts[1])
    same()
    ST.write_rows(flat(spark, 4).withColumn("value", F.lit(1e9)), path, "lost")  # never committed, never seen
    arrive(parts[2])
    same()
    ST.compact_tiers(spark, path, fanout=2)
    arrive(parts[3], parts[4])
    same()
    board = SS.leaderboard(spark, state, "reasoning", "t1", "accuracy")
    opened = board.inputFiles()
    assert opened and all(f"{state}/" in f for f in opened)
    snapshots = {int(n) for f in opened for n in re.findall(r"snapshots/upto=(\d+)", f)}
    assert len(snapshots) == 1
    text = board._jdf.queryExecution().explainString(board.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(rf"PartitionFilters: \[[^\]]*number#\d+L > {max(snapshots)}\)", text)


def test_state_of_nothing(spark, tmp_path):
    assert SS.leaderboard(spark, str(tmp_path / "none"), "s", "t", "m").collect() == []
