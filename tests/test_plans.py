"""What the plans look like: shuffles, scans, no Python in the tasks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from evalspark.operators import results as Q
from evalspark.plans import catalog
from evalspark.plans.bindings import flat_results, order_envelopes
from evalspark.sources import store as ST
from evalspark.sources.shards import read_shards


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"\bExchange (hash|range|Single|Round)", plan(df)))


# Most shuffles each query may have.
NARROW = {
    "c1_explode_task_metrics": 0,
    "c8_extract_gen_kwargs": 0,
    "c14_assemble_envelopes": 0,
    "f1_flatten": 0,
    "v0a_violations": 0,
    "v0b_split_valid": 0,
    "s5_shard_key": 0,
    "s6_publish_plan": 0,
    "a2_tool_calls": 0,
    "a6_runs_to_results": 0,
    "q2_select_results": 0,
    "t7_render_prompts": 0,
    "r7_budget_flag": 0,
}
ONE_SHUFFLE = {
    "q3_latest_by_model": 1,
    "q3_latest_by_model_row": 1,
    "q8_latest_by_model_task": 1,
    "q14_dataset_stats": 2,
    "t8_first_n_per_task": 1,
    "a1_summarize_runs": 1,
    "a4_steps_from_calls": 2,
    "r3_concurrency_speedup": 1,
    "r4_stream_timing": 1,
    "v0c_violation_summary": 1,
}


@pytest.mark.parametrize("name", [*NARROW, *ONE_SHUFFLE])
def test_number_of_shuffles(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    assert shuffles(df) <= {**NARROW, **ONE_SHUFFLE}[name], plan(df)
    assert not re.search(r"EvalPython|InPandas|InArrow|ArrowPython", plan(df))
    assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)


def test_group_limits_work_before_the_shuffle(spark, sf_dir):
    for name in ("q3_latest_by_model_row", "t8_first_n_per_task"):
        text = plan(catalog.QUERIES[name](spark, sf_dir))
        assert "WindowGroupLimit" in text and "Partial" in text


def test_selection_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "store")
    ST.write_results(flat_results(spark, sf_dir), path)
    board = Q.leaderboard(read_shards(spark, path), "reasoning", "task_1", "exact_match_flexible")
    text = plan(board)
    assert re.search(r"PartitionFilters: \[[^\]]*suite", text)
    assert "EqualTo(name,task_1)" in text and "EqualTo(metric,exact_match_flexible)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "tags" not in schema and "git_sha" not in schema


def test_keys_of_the_store_are_read_alone(spark, sf_dir, tmp_path):
    path = str(tmp_path / "store")
    runs = order_envelopes(spark, sf_dir)
    ST.append_new(runs.where("suite = 'coding'"), path)
    text = plan(ST.new_runs(runs, ST.stored_keys(ST.read_keys(spark, path), runs)))
    (scan,) = [line for line in text.splitlines() if "ReadSchema: struct<content_sha:string" in line]
    assert re.search(r"PartitionFilters: \[[^\]]*suite", scan) and "GreaterThanOrEqual(day" in scan
    assert re.search(r"ReadSchema: struct<content_sha:string,day:date>", scan)


def test_costly_columns_are_computed_once(spark, sf_dir):
    """A filter on what a conversion found must not repeat the conversion below it."""
    text = plan(catalog.QUERIES["f1_flatten"](spark, sf_dir))
    assert len(re.findall(r"from_json", text)) == 1


def test_a_hot_suite_is_spread_over_files(spark, tmp_path):
    hot = spark.range(100).select(F.lit("hot").alias("suite"), F.col("id").alias("value"))
    assert "rebalance" in hot.hint("rebalance", F.col("suite"))._jdf.queryExecution().toString().lower()
    ST.write_results(hot, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
