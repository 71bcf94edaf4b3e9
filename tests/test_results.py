from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from evalspark.operators import results as Q
from evalspark.sources.shards import empty_results, with_derived

COLUMNS = "timestamp string, suite string, name string, metric string, model string, value double, shard_key string"


def rows_of(spark, rows):
    return with_derived(spark.createDataFrame(rows, COLUMNS))


SAMPLE = [
    ("2026-04-24T18:30:00Z", "reasoning", "gsm8k", "exact_match_flexible", "mlx-community/Qwen3.5-9B-MLX-4bit", 0.8, "a"),
    ("2026-04-24T19:00:00Z", "reasoning", "gsm8k", "exact_match_flexible", "openrouter/openai/gpt-5-mini", 0.6, "b"),
]
PICK = ("reasoning", "gsm8k", "exact_match_flexible")


def test_leaderboard_is_lowest_first(spark):
    board = Q.leaderboard(rows_of(spark, SAMPLE), *PICK).collect()
    assert [(r["label"], r["value"]) for r in board] == [("openrouter/gpt-5-mini", 0.6), ("Qwen3.5-9B-MLX-4bit", 0.8)]


def test_models_without_a_score_are_last(spark):
    extra = [("2026-04-24T20:00:00Z", *PICK, "m", None, "c")]
    assert [r["label"] for r in Q.leaderboard(rows_of(spark, SAMPLE + extra), *PICK).collect()][-1] == "m"


LATEST = [
    ("2026-01-01T00:00:00Z", *PICK, "m", 1.0, "a"),
    ("2026-01-02T00:00:00Z", *PICK, "m", None, "b"),
    ("2026-01-03T00:00:00Z", *PICK, None, 9.0, "c"),
    ("2026-01-01T00:00:00Z", *PICK, "n", 1.0, "a"),
    (None, *PICK, "n", 2.0, "a"),
    ("2026-01-01T00:00:00Z", *PICK, "t", 5.0, "z"),
    ("2026-01-01T00:00:00Z", *PICK, "t", 7.0, "a"),
]


def test_latest_takes_the_last_value_of_each_column(spark):
    got = {r["model"]: (str(r["timestamp"])[:10], r["value"]) for r in Q.latest_by_model(rows_of(spark, LATEST)).collect()}
    # A missing time counts as newest; of equal times the larger shard key wins; no model, no row.
    assert got == {"m": ("2026-01-02", 1.0), "n": ("2026-01-01", 2.0), "t": ("2026-01-01", 5.0)}


def test_latest_row_keeps_the_row(spark):
    got = {r["model"]: (r["timestamp"] and str(r["timestamp"])[:10], r["value"]) for r in Q.latest_by_model(rows_of(spark, LATEST), "row").collect()}
    assert got == {"m": ("2026-01-02", None), "n": (None, 2.0), "t": ("2026-01-01", 5.0)}


def test_axis(spark):
    def axis(values):
        return Q.axis_max(spark.createDataFrame([(v,) for v in values], "value double")).first()["axis_max"]

    assert axis([0.2, 0.5]) == 1.0 and axis([2.0, None]) == 2.0 * 1.15 and axis([None]) == 1.0 and axis([]) == 1.0


def test_score_label(spark):
    assert Q.labelled(rows_of(spark, SAMPLE)).orderBy("value").first()["text"] == "0.600"


def test_trend_is_ordered_and_keeps_every_run(spark):
    data = rows_of(spark, LATEST)
    values = [r["value"] for r in Q.trend(data.where("model IS NOT NULL"), *PICK, ["m", "t"]).collect()]
    assert sorted(map(str, values)) == ["1.0", "5.0", "7.0", "None"] and values[-1] is None
    many = spark.createDataFrame([("m",)], "model_short string")
    assert Q.trend(data, *PICK, many).count() == 2
    assert Q.trend(data, *PICK, []).count() == 7


def test_pivot(spark):
    data = rows_of(
        spark,
        [
            ("2026-01-01T00:00:00Z", "reasoning", "b", "m", "x", 0.00015, "a"),
            ("2026-01-02T00:00:00Z", "reasoning", "a", "m", "x", 0.123456, "a"),
            ("2026-01-01T00:00:00Z", "reasoning", "a", "m", "mlx-community/y", 1.0, "a"),
            ("2026-01-01T00:00:00Z", "reasoning", "a", "other", "z", 1.0, "a"),
        ],
    )
    got = Q.summary_pivot(data, "reasoning", "m")
    assert got.columns == ["Model", "a", "b"]
    assert [tuple(r) for r in got.collect()] == [("x", 0.1235, 0.0001), ("y", 1.0, None)]


def test_pivot_refuses_two_models_with_one_short_name(spark):
    data = rows_of(
        spark,
        [
            ("2026-01-01T00:00:00Z", "s", "a", "m", "mlx-community/y", 1.0, "a"),
            ("2026-01-02T00:00:00Z", "s", "a", "m", "y", 2.0, "a"),
        ],
    )
    with pytest.raises(Exception, match="two models share the short name y"):
        Q.summary_pivot(data, "s", "m").collect()
    assert [tuple(r) for r in Q.summary_pivot(data, "s", "m", on_duplicate="latest").collect()] == [("y", 2.0)]


def test_empty_data_never_fails(spark):
    empty = empty_results(spark)
    assert Q.leaderboard(empty, *PICK).count() == 0
    assert Q.summary_pivot(empty, "reasoning", "m").columns == ["Model"]
    assert Q.facets(empty).count() == 0
    assert Q.or_no_data(Q.select_results(empty, "x")).first()["message"] == Q.NO_DATA
    assert tuple(Q.default_selection(empty).first()) == ("reasoning", None, None)
    assert tuple(Q.dataset_stats(empty).first()) == (0, 0)
    full = Q.or_no_data(rows_of(spark, SAMPLE))
    assert full.count() == 2 and full.where("message IS NOT NULL").count() == 0


def test_facets_and_defaults(spark):
    data = rows_of(spark, [*SAMPLE, ("2026-01-01T00:00:00Z", "coding", "a", "accuracy", "b-model", 1.0, "x"), ("2026-01-01T00:00:00Z", "coding", "a", "bb", None, 1.0, "x")])
    values = [(r["facet"], r["value"]) for r in Q.facets_for_suite(data, "coding").collect()]
    assert values == [("metric", "accuracy"), ("metric", "bb"), ("name", "a")]
    assert tuple(Q.default_selection(data).first()) == ("reasoning", "a", "exact_match_flexible")
    by_suite = {r["suite"]: (r["task"], r["metric"]) for r in Q.default_selection_by_suite(data).collect()}
    assert by_suite == {"coding": ("a", "accuracy"), "reasoning": ("gsm8k", "exact_match_flexible")}
    assert [r["model_short"] for r in Q.first_models(data, 2).collect()] == ["b-model", "Qwen3.5-9B-MLX-4bit"]
    assert tuple(Q.dataset_stats(data).first()) == (4, 3)


def test_times_with_and_without_fractions(spark):
    data = rows_of(spark, [("2026-01-01T00:00:00.5Z", *PICK, "m", 1.0, "a"), ("2026-01-01T00:00:00Z", *PICK, "n", 1.0, "a")])
    assert data.where(F.col("timestamp").isNull()).count() == 0
