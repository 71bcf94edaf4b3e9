"""Objects in objects are read as they were one level at a time."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from evalspark.functions import variants as V
from evalspark.operators import convert as C
from evalspark.plans.bindings import ingest_time
from evalspark.sources import facets as FA
from evalspark.sources.raw import parse_documents

VALUES = ['{"a": {"x": 1, "y": null}, "b": {}, "c": null, "d": 3, "e": [1], "f": "s", "_": {"_": true}}', "{}", "[]", "null", "3", '"s"', '{"_": "no"}', "nonsense"]


def test_levels_are_read_at_once(spark):
    docs = parse_documents(spark.createDataFrame(list(enumerate(VALUES)), "id int, raw string"))
    once = F.transform_values(V.fields_of_fields(F.col("doc")), lambda _, m: F.transform_values(m, lambda _, v: F.to_json(v)))
    by_level = F.transform_values(V.fields(F.col("doc")), lambda _, v: F.transform_values(V.fields(v), lambda _, w: F.to_json(w)))
    got = docs.select("raw", once.alias("a"), by_level.alias("b"), V.is_object(F.col("doc")).alias("c"), V.fields(F.col("doc")).isNotNull().alias("d")).collect()
    assert len(got) == len(VALUES)
    for r in got:
        assert r["a"] == r["b"] and r["c"] == r["d"], r["raw"]
    assert got[0]["a"]["c"] is None and got[0]["a"]["a"] == {"x": "1", "y": "null"} and [r["c"] for r in got] == [True, True, False, False, False, False, True, False]


def test_odd_results_and_their_problems(spark):
    raws = ['{"results": %s}' % v for v in VALUES[:-1]] + ['{"config": {"model_args": 1, "gen_kwargs": ""}, "results": {"t": {"m": 1, "n": "x", "o": {"p": 1}}}}', "[1]"]
    docs = C.fill_run_context(parse_documents(spark.createDataFrame(list(enumerate(raws)), "id int, raw string")))
    got = {r["id"]: r for r in C.convert(docs, "lm-eval", ["id"], ingest_time()).collect()}
    odd = [f"metrics are not an object: {t}" for t in "cdef"]
    want = {0: odd, 1: [], 2: [], 3: [], 4: ["results is not an object"], 5: ["results is not an object"], 6: ["metrics are not an object: _"], 7: ["config.model_args is not an object"], 8: ["document is not an object"]}
    assert {i: sorted(r["problems"]) for i, r in got.items()} == want
    assert [[(m["name"], m["metric"], m["value"]) for m in got[i]["results"]] for i in (0, 1, 2, 7, 8)] == [[("_", "_", 1.0), ("a", "x", 1.0)], [], [], [("t", "m", 1.0)], []]


def test_conversion_copies_results_once(spark):
    """A ``map<string,variant>`` is a copy of all that an object holds; of the results there is one map of maps instead."""
    docs = C.fill_run_context(parse_documents(spark.createDataFrame([(0, "{}")], "id int, raw string")))
    plan = C.convert(docs, "lm-eval", ["id"], ingest_time())._jdf.queryExecution().analyzed().toString()
    read = re.findall(r"\[results\], \$, MapType\(StringType,(\w+)", plan)
    assert sorted(read) == ["MapType", "StructType"]


def test_the_index_of_odd_values(spark, tmp_path):
    rows = [("s", "n", "m", "a", {"k": "1", "l": None}), ("s", None, "m", "a", {}), ("s", "n", None, None, None), (None, "n", "m", "b", {"k": "2"}), ("s", "n", "m", "a", {"k": "3"})]
    path = str(tmp_path / "store")
    spark.createDataFrame(rows, "suite string, name string, metric string, model string, tags map<string,string>").write.partitionBy("suite").parquet(f"{path}/batch_id=b")
    FA.write_facets(spark, path, "b")
    got = {(r["suite"], r["facet"], r["metric"], r["value"]): r["n"] for r in spark.read.parquet(f"{path}_facets/batch_id=b").collect()}
    want = {}
    for suite, name, metric, model, tags in rows:
        own = [("suite", None, suite), ("name", None, name), ("metric", None, metric), ("model", None, model), ("name of metric", metric, name)]
        for facet, m, v in own + [("tag", None, k) for k in tags or {}]:
            want[suite, facet, m, v] = want.get((suite, facet, m, v), 0) + 1
    assert got == want
