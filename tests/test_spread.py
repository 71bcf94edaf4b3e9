"""How the rows of a source are dealt to tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark.plans import bindings


def test_a_file_of_one_row_group_is_dealt_by_its_rows(spark, tmp_path):
    path, n = str(tmp_path / "t"), 2 * bindings.ROWS_PER_TASK + 1
    spark.range(0, n, 1, 1).write.parquet(path)
    dealt = bindings.spread(spark.read.parquet(path))
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 3 and max(sizes) < bindings.ROWS_PER_TASK
    assert dealt.agg(F.count_distinct("id"), F.sum("id")).first()[:] == (n, n * (n - 1) // 2)
    few = bindings.spread(spark.read.parquet(path).limit(10))
    assert "Exchange Round" not in few._jdf.queryExecution().executedPlan().toString() and few.count() == 10
