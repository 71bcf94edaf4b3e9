"""pass@k from a table of outcomes. Code is never run here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def estimate(n: Column, c: Column, k: int) -> Column:
    """Unbiased chance that one of ``k`` draws from ``n`` samples with ``c`` correct ones is correct.

    Written as a product of ``k`` factors, so its cost does not depend on how many samples a problem has. With
    fewer than ``k`` wrong samples it is 1; for ``k = 1`` it is the plain share.
    """
    if k == 1:
        return c / n
    all_wrong = reduce(lambda p, i: p * (n - c - i) / (n - i), range(k), F.lit(1.0))
    return F.when(n - c < k, F.lit(1.0)).otherwise(1.0 - all_wrong)


def problem_counts(outcomes: DataFrame, task: list[str], problem: str = "problem", correct: str = "correct") -> DataFrame:
    """Samples ``n`` and correct samples ``c`` of every problem."""
    return outcomes.groupBy(*task, problem).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(correct).cast("boolean").cast("bigint")).alias("c")
    )


def pass_at_k(
    outcomes: DataFrame, ks: list[int], task: list[str], problem: str = "problem", correct: str = "correct"
) -> DataFrame:
    """Mean of the estimates over the problems of each task: columns ``pass_at_<k>``.

    NULL where a problem of the task has fewer than ``k`` samples.
    """
    counts = problem_counts(outcomes, task, problem, correct)
    # Division by zero is guarded, since the estimate of a problem with too few samples is not used.
    usable = [
        F.when(F.min("n") >= k, F.avg(F.when(F.col("n") >= k, estimate(F.col("n"), F.col("c"), k)))).alias(f"pass_at_{k}")
        for k in ks
    ]
    return counts.groupBy(*task).agg(F.count(F.lit(1)).alias("n_problems"), *usable)


def scores_to_results(scores: DataFrame, task: str, ks: list[int]) -> DataFrame:
    """Scores in the form in which a task-evaluation document states them: ``name, metric_key, value``."""
    each = F.array(*[F.struct(F.lit(f"pass@{k},none").alias("metric_key"), F.col(f"pass_at_{k}").alias("value")) for k in ks])
    rows = scores.select(F.col(task).alias("name"), F.explode(each).alias("m"))
    return rows.select("name", "m.metric_key", "m.value").where("value IS NOT NULL")
