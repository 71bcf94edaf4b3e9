"""Manifests: what counts when drivers are lost, merges, listing, and the index of values."""

from __future__ import annotations

import itertools
import shutil
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from evalspark.operators import flatten as FL
from evalspark.operators import results as Q
from evalspark.operators.publish import publish
from evalspark.plans.bindings import order_envelopes
from evalspark.sources import commits as CM
from evalspark.sources import facets as FA
from evalspark.sources import store as ST
from evalspark.sources.shards import read_shards
from fixtures import TASK_DOCUMENT, VALID_ENVELOPE
from test_store import envelopes
from test_streaming import context

SUITE = '"suite": "reasoning"'


def many(spark, n, day=None):
    raws = [VALID_ENVELOPE.replace("0.375", str(i + 0.5)) for i in range(n)]
    if day:
        raws = [r.replace("2025-03-14", day) for r in raws]
    return envelopes(spark, *raws)


def values(spark, path):
    return sorted(r["value"] for r in read_shards(spark, path).collect())


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["write_rows", "_write_keys", "finish", "facets", "commit"])
@pytest.mark.parametrize("named", [True, False])
def test_a_driver_lost_at_any_step(spark, tmp_path, monkeypatch, step, named):
    path = str(tmp_path / "store")
    runs = many(spark, 5)
    ST.append_new(runs.where("id < 2"), path)
    module, name = {"facets": (ST.FA, "write_facets"), "commit": (ST.CM, "commit")}.get(step, (ST, step))
    real = getattr(module, name)

    def lost(*args, **kwargs):
        if step in ("write_rows", "_write_keys"):
            real(*args, **kwargs)
        raise Lost

    monkeypatch.setattr(module, name, lost)
    with pytest.raises(Lost):
        ST.append_new(runs, path, "b" if named else None)
    monkeypatch.undo()
    assert values(spark, path) == [0.5, 1.5]
    ST.append_new(runs, path, "b" if named else None)
    ST.append_new(runs, path)
    assert values(spark, path) == [0.5, 1.5, 2.5, 3.5, 4.5]
    assert ST.read_keys(spark, path).count() == 5


@pytest.mark.parametrize("step", ["write_rows", "write_rejects"])
def test_a_publish_is_made_again_without_a_name(spark, tmp_path, monkeypatch, step):
    raws = [TASK_DOCUMENT, TASK_DOCUMENT.replace("0.375", "0.25"), "{bad", '{"a": 1} {"b": 2}', TASK_DOCUMENT + "<<<<<<< HEAD"]
    docs = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, raw string")
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    args = (docs, F.col("kind"), ["id"], out, rejects, context, F.lit("2026-01-01").cast("timestamp"))
    real = getattr(ST, step)

    def lost(*a, **k):
        real(*a, **k)
        raise Lost

    monkeypatch.setattr(ST, step, lost)
    with pytest.raises(Lost):
        publish(*args)
    monkeypatch.undo()
    plan = publish(*args).collect()
    assert {r["id"] for r in plan} == {0, 1}
    assert read_shards(spark, out).count() == 4
    assert sorted(r["id"] for r in spark.read.parquet(rejects).collect()) == [2, 3, 4]


def test_a_store_from_before_there_were_manifests(spark, tmp_path):
    path = str(tmp_path / "store")
    runs = many(spark, 4)
    ST.append_new(runs.where("id < 2"), path, "old-1")
    ST.write_results(ST.publishable_rows(runs.where("id IN (1, 2)")), path, "old-2")
    shutil.rmtree(path + "_commits")
    shutil.rmtree(path + "_facets")
    shutil.rmtree(path + "_keys/batch_id=old-2")
    assert values(spark, path) == [0.5, 1.5, 1.5, 2.5]
    ST.compact(spark, path, path + "-new")  # rows without keys are not lost
    assert values(spark, path + "-new") == [0.5, 1.5, 2.5]
    ST.append_new(runs, path)
    assert values(spark, path) == [0.5, 1.5, 1.5, 2.5, 3.5]
    assert FA.dataset_stats(FA.read_facets(spark, path)).first()["n_rows"] == 5


def test_rows_without_a_key_are_refused(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = ST.publishable_rows(many(spark, 2))
    with pytest.raises(PySparkException, match="cannot be told apart"):
        ST.write_results(rows.withColumn("content_sha", F.lit(None).cast("string")), path)
    assert read_shards(spark, path).count() == 0
    ST.write_results(rows, path)
    with pytest.raises(ValueError, match="cannot be told apart"):
        ST.write_results(rows.drop("content_sha"), path)
    ST.write_rows(rows.drop("content_sha"), str(tmp_path / "shards"), "a")
    with pytest.raises(PySparkException, match="cannot be told apart"):
        ST.compact(spark, str(tmp_path / "shards"), str(tmp_path / "into"))
    assert read_shards(spark, str(tmp_path / "into")).count() == 0


def test_readers_open_the_batches_of_their_suites_and_days(spark, tmp_path):
    path = str(tmp_path / "store")
    for name, day, suite in (("a", "2025-03-14", "reasoning"), ("b", "2025-04-01", "reasoning"), ("c", "2025-04-02", "coding")):
        runs = many(spark, 2, day).withColumn("suite", F.lit(suite))
        ST.append_new(runs, path, name)
    undated = many(spark, 1).withColumns({"suite": F.lit("coding"), "timestamp": F.lit(None).cast("string")})
    ST.append_new(undated, path, "d")

    def opened(**chosen):
        df = read_shards(spark, path, **chosen)
        return sorted({f.split("batch_id=")[1].split("/")[0] for f in df.inputFiles()}), df.count()

    assert opened() == (["a", "b", "c", "d"], 7)
    assert opened(suites=["reasoning"]) == (["a", "b"], 4)
    assert opened(suites=["knowledge"]) == ([], 0)
    assert opened(days=(date(2025, 3, 20), date(2025, 4, 1))) == (["b", "d"], 3)
    assert opened(suites=["coding"], days=(date(2025, 4, 2), date(2025, 4, 9))) == (["c", "d"], 3)
    assert opened(suites=["reasoning"], days=(date(2025, 3, 14), date(2025, 3, 14))) == (["a"], 2)


def test_merges_by_size_class(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "SMALLEST_TIER", 4)
    path = str(tmp_path / "store")
    runs = many(spark, 8)
    written = []
    real = ST.write_rows

    def counted(rows, *args):
        real(rows, *args)
        written.append(rows.count())

    for i in range(8):
        ST.append_new(runs.where(F.col("id") == i), path, f"b{i:02}")
        if i == 2:  # a publisher that did not see what is stored
            ST.write_results(ST.publishable_rows(runs.where("id IN (0, 1)")), path, "unaware")
        monkeypatch.setattr(ST, "write_rows", counted)
        ST.compact_tiers(spark, path, fanout=2)
        monkeypatch.setattr(ST, "write_rows", real)
    assert values(spark, path) == [i + 0.5 for i in range(8)]
    assert len(written) >= 3 and sum(written) <= 3 * 10  # every row once for each class it has passed
    batches = CM.live_batches(spark, path)
    assert len([b for b in batches.values() if b.n_rows]) < 4
    assert ST.compact_tiers(spark, path, fanout=2) == 0
    ST.append_new(runs, path)
    assert values(spark, path) == [i + 0.5 for i in range(8)]
    # What is not needed any more can go; the manifests stay.
    for name in CM.unused(spark, path):
        for folder in ("", "_keys", "_facets"):
            shutil.rmtree(f"{path}{folder}/batch_id={name}", ignore_errors=True)
    assert values(spark, path) == [i + 0.5 for i in range(8)]


def test_a_lost_merge_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    runs = many(spark, 4)
    for i in range(4):
        ST.append_new(runs.where(F.col("id") == i), path, f"b{i}")

    def lost(*args, **kwargs):
        raise Lost

    monkeypatch.setattr(ST.CM, "commit", lost)
    with pytest.raises(Lost):
        ST.compact_tiers(spark, path)
    monkeypatch.undo()
    assert values(spark, path) == [0.5, 1.5, 2.5, 3.5]
    ST.compact_tiers(spark, path)
    assert values(spark, path) == [0.5, 1.5, 2.5, 3.5]


def test_merges_at_the_same_time():
    """In whatever order manifests are listed, each row belongs to one batch that counts."""

    def batch(name, *replaces, level=0):
        return CM.Batch(name, 1, 1, None, None, None, False, level, replaces)

    found = [batch(n) for n in "abcde"] + [batch("m1", "a", "b", level=1), batch("m2", "b", "c", level=1), batch("m3", "m2", "d", level=2), batch("m4", "m1", "e", level=2)]
    for order in itertools.islice(itertools.permutations(found), 0, None, 5_000):
        assert set(CM.live(list(order))) == {"m4", "c", "d"}


def test_the_index_equals_a_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "store")
    runs = order_envelopes(spark, sf_dir)
    tagged = F.transform("results", lambda r: r.withField("tags", F.map_concat(r["tags"], F.create_map(F.concat(F.lit("tag "), F.col("suite")), F.lit("x")))))
    runs = runs.withColumn("results", tagged).withColumn("model", F.when(F.col("o_orderkey") % 7 != 0, F.col("model")))
    ST.append_new(runs.where("suite = 'coding'"), path)

    def same():
        rows, index = read_shards(spark, path), FA.read_facets(spark, path)

        def rows_of(df):
            return [tuple(r) for r in df.collect()]

        assert rows_of(FA.facets(index)) == rows_of(Q.facets(rows))
        for suite in ("coding", "reasoning"):
            assert rows_of(FA.facets(index, ("name", "metric"), suite)) == rows_of(Q.facets_for_suite(rows, suite))
            names = [r[0] for r in rows_of(FA.pivot_names(index, suite, "price"))]
            assert names == sorted({r["name"] for r in rows.where(F.col("suite") == suite).collect()})
        assert [r[0] for r in rows_of(FA.tag_keys(index))] == FL.tag_keys(rows)
        assert rows_of(FA.dataset_stats(index)) == rows_of(Q.dataset_stats(rows))
        assert rows_of(FA.default_selection(index)) == rows_of(Q.default_selection(rows))
        assert rows_of(FA.first_models(index)) == rows_of(Q.first_models(rows).select("model", "model_short"))
        assert not [f for f in FA.facets(index).inputFiles() if "_facets" not in f]

    same()
    ST.append_new(runs, path)
    same()
    ST.compact_tiers(spark, path, fanout=2)
    same()
    ST.compact(spark, path, path + "-new")
    path += "-new"
    same()


def test_the_index_of_nothing(spark, tmp_path):
    index = FA.read_facets(spark, str(tmp_path / "nothing"))
    assert FA.facets(index).count() == 0 and tuple(FA.dataset_stats(index).first()) == (0, 0)
