"""Mixing and sharding."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import islice

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evalspark.llm import mixing, sharding


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.text(min_size=1, max_size=4), st.floats(0, 100), min_size=1, max_size=12))
def test_less_than_one_block_from_the_target(weights):
    blocks = dict.fromkeys(weights, 240)  # no source runs out
    whole = mixing.whole_weights(weights, blocks, 240)
    total, done = sum(whole.values()), Counter()
    for slot, (source, nth, release, deadline, at) in enumerate(islice(mixing.layout(whole, blocks), 240)):
        assert at == slot and nth == done[source] and release <= slot < deadline
        done[source] += 1
        assert all(abs(done[s] - Fraction(w, total) * (slot + 1)) < 1 for s, w in whole.items())


def brute_schedule(sizes, block_rows):
    """Of the sources' weights, the square roots of their rows: in each slot the released block that is due first."""
    exact = {s: Fraction(float(n) ** 0.5) for s, n in sizes.items()}
    total = sum(exact.values())
    left = {s: -(-n // block_rows) for s, n in sizes.items()}
    done, slot, out = Counter(), 0, {}
    while any(done[s] < left[s] for s in sizes):
        ready = [s for s in sizes if done[s] < left[s] and done[s] * total // exact[s] <= slot]
        if ready:
            first = min(ready, key=lambda s: (-(-(done[s] + 1) * total // exact[s]), s))
            out[first, done[first]] = slot
            done[first] += 1
        slot += 1
    return out


def test_the_query_against_every_slot_looked_at(spark, sf_dir, documents):
    import __spark_entry__ as entry

    sizes = Counter("=" + r.source for r in documents.select("source").collect())
    want = brute_schedule(sizes, mixing.BLOCK_ROWS)
    got = {("=" + r.source, r.block): r.slot for r in entry.queries()["op5_mixing"](spark, sf_dir).collect()}
    assert got == want


def test_unequal_sources_against_every_slot_looked_at(frame):
    sizes = {"a": 300, "b": 70, "c": 9, "d": 1}
    docs = frame([(i, "x", None, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))])
    got = {("=" + r.source, r.block): r.slot for r in mixing.schedule(docs, block_rows=2).collect()}
    assert got == brute_schedule({"=" + s: n for s, n in sizes.items()}, 2)


def test_large_tables_have_large_blocks():
    assert mixing.block_rows_for(0) == mixing.block_rows_for(32_000_000) == mixing.BLOCK_ROWS
    assert mixing.block_rows_for(40_000_000_000) == 10_000


def test_schedule(documents, document_rows):
    weights = {f"src{i}": i + 1 for i in range(20)}
    rows = mixing.schedule(documents, weights, period=2100, block_rows=2).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r[0] for r in document_rows)
    assert len({r.place for r in rows}) == len(rows)
    blocks = defaultdict(set)
    for r in rows:
        assert r.release <= r.slot < r.deadline and r.slot == r.place // 2
        blocks[r.source].add((r.block, r.slot))
    for own in blocks.values():
        ordered = sorted(own)
        assert [b for b, _ in ordered] == list(range(len(ordered))) and [s for _, s in ordered] == sorted(s for _, s in ordered)
    until = min(max(s for _, s in own) for own in blocks.values())  # no source has run out before
    for t in range(until + 1):
        for source, own in blocks.items():
            assert abs(sum(s < t for _, s in own) - t * weights[source] / 210) < 1


def test_later_periods_continue(frame):
    rows = mixing.schedule(frame([(i, "x", None, "ab"[i % 2]) for i in range(400)]), {"a": 3, "b": 1}, period=4, block_rows=1).collect()
    assert len({r.slot for r in rows}) == 400
    first = sorted(r.slot for r in rows if r.source == "b")
    assert all(4 * i <= s < 4 * i + 4 for i, s in enumerate(first))


def test_the_target_is_kept_over_many_periods(frame):
    docs = frame([(i, "x", None, "b" if i % 10 == 0 else "a") for i in range(2000)])
    rows = mixing.schedule(docs, {"a": 0.9, "b": 0.1}, period=20, block_rows=1).collect()
    weights = {"a": Fraction(0.9), "b": Fraction(0.1)}
    done = Counter()
    for t, r in enumerate(sorted(rows, key=lambda r: r.slot)[:1990], start=1):
        done[r.source] += 1
        assert r.slot == t - 1 and all(abs(done[s] - w / sum(weights.values()) * t) < 1 for s, w in weights.items())


@pytest.mark.parametrize("by_shuffle", [False, True])
def test_any_number_of_sources(monkeypatch, frame, by_shuffle):
    if by_shuffle:
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 10)
    weights = {"hot": 1100.0} | {f"s{i}": 1.0 for i in range(1100)}
    docs = frame([(i, "x", None, "hot" if i < 1100 else f"s{i - 1100}") for i in range(2200)])
    rows = sorted(mixing.schedule(docs, weights, block_rows=1).collect(), key=lambda r: r.place)
    assert [r.place for r in rows] == list(range(2200)) and len({r.doc_id for r in rows}) == 2200
    hot = 0
    for t, r in enumerate(rows, start=1):
        hot += r.source == "hot"
        assert abs(hot - t / 2) < 1
    assert mixing.schedule(docs).count() == 2200


def test_least_shares():
    blocks = {"a": 10, "b": 10, "c": 1}
    assert mixing.whole_weights({"a": 3.0, "b": 1.0, "c": 0.0}, blocks, 100) == {"a": 297, "b": 99, "c": 4}
    assert mixing.whole_weights({"a": 3.0, "b": 1e-300, "c": 1.0}, blocks, 100) == {"a": 297, "b": 4, "c": 99}
    assert mixing.whole_weights(dict.fromkeys(blocks, 0.0), blocks) == dict.fromkeys(blocks, 1)
    last = {s: slot for s, _, _, _, slot in mixing.layout({"a": 1, "b": 10**12}, {"a": 3, "b": 2})}
    assert 2 * 10**12 < last["a"] < 3 * 10**12 + 3


def test_mixing_odd_rows(odd, frame):
    rows = mixing.schedule(odd).collect()
    assert len(rows) == 11 and len({r.place for r in rows}) == 11 and None in {r.source for r in rows}
    assert len(mixing.schedule(odd, {"a": 1.0}).collect()) == 11
    assert mixing.schedule(frame([])).count() == 0
    with pytest.raises(ValueError, match="sources"):
        mixing.schedule(odd, max_sources=2)
    with pytest.raises(ValueError, match="negative"):
        mixing.schedule(odd, {"a": -1.0})


def size(text):
    return len((text or "").encode()) + 1


def test_shards(spark, tmp_path, documents, document_rows):
    rows = sharding.assign(documents, 16, str(tmp_path / "map")).collect()
    texts = {r[0]: r[1] for r in document_rows}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    loads, slots = Counter(), defaultdict(list)
    for r in rows:
        assert r.size == size(texts[r.doc_id]) and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode())
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.rebalanced_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(loads) == set(range(16)) and max(loads.values()) - min(loads.values()) <= max(map(size, texts.values()))
    moved = sum(r.size for r in rows if r.rebalanced_shard == 16)
    assert 0.5 * sum(loads.values()) / 17 < moved <= sum(loads.values()) / 17
    first, last = sharding.SlotMap.load(spark, str(tmp_path / "map"), 1), sharding.SlotMap.load(spark, str(tmp_path / "map"))
    assert (first.version, last.version) == (1, 2) and len(first.shard) == len(last.shard) == sharding.N_SLOTS
    assert all(r.shard == first.shard[r.vslot] and r.rebalanced_shard == last.shard[r.vslot] for r in rows)
    with pytest.raises(Exception, match="(?i)exists"):
        last.save(spark, str(tmp_path / "map"))


def test_more_documents_do_not_move_slots(tmp_path, documents):
    few = {r.doc_id: r.vslot for r in sharding.assign(documents.filter("doc_id % 2 = 0"), 4, str(tmp_path / "a")).collect()}
    all_ = {r.doc_id: r.vslot for r in sharding.assign(documents, 4, str(tmp_path / "b")).collect()}
    assert few.items() <= all_.items()


def test_one_id_of_many_records_is_spread(tmp_path, frame):
    docs = frame([(1 if i % 3 == 0 else None, f"text {i} " * 20, None, None) for i in range(900)])
    loads = Counter()
    for r in sharding.assign(docs, 4, str(tmp_path / "a")).collect():
        loads[r.shard] += r.size
    assert max(loads.values()) < 1.05 * min(loads.values())
    together = sharding.place(docs, 4, str(tmp_path / "b"), by=("doc_id",))
    assert together.select("vslot").distinct().count() == 2


def test_more_shards_than_slots(tmp_path, documents):
    assert sharding.slots_for(16) == 4096 and sharding.slots_for(5000) == 1 << 19
    with pytest.raises(ValueError, match="do not share"):
        sharding.assign(documents, 5000, str(tmp_path / "a"), n_slots=4096)
    rows = sharding.assign(documents, 100, str(tmp_path / "b")).collect()
    assert {r.shard for r in rows} <= set(range(100)) and len({r.shard for r in rows}) > 60


def test_a_stored_map_goes_on(spark, tmp_path, documents):
    path = str(tmp_path / "map")
    first = sharding.place_more(documents.filter("doc_id < 100"), 4, path)
    more = documents.filter("doc_id >= 100")
    second = sharding.place_more(more, 4, path)
    one, two = sharding.SlotMap.load(spark, path, 1), sharding.SlotMap.load(spark, path)
    assert one.shard == two.shard and two.version == 3 and sum(two.sizes.values()) == sum(size(r.text) for r in documents.collect())
    assert all(r.shard == one.shard[r.vslot] for r in first.collect() + second.collect())
    third = sharding.place_more(documents, 6, path)
    grown = sharding.SlotMap.load(spark, path)
    assert grown.version == 4 and set(grown.shard.values()) == set(range(6))
    assert all(grown.shard[s] in (to, 4, 5) for s, to in two.shard.items())
    assert all(r.shard == grown.shard[r.vslot] for r in third.collect())
    with pytest.raises(ValueError, match="more than 3 shards"):
        sharding.place_more(documents, 3, path)


def test_a_heavy_slot_and_growth_by_several():
    sizes = {0: 1000, **{i: 10 for i in range(1, 64)}}
    first = sharding.SlotMap.fresh(sizes, 4, 64)
    assert sorted(first.loads().values())[-1] == 1000 and len([s for s, to in first.shard.items() if to == first.shard[0]]) == 1
    more = first.grown(2)
    assert all(more.shard[s] in (first.shard[s], 4, 5) for s in range(64))
    assert max(more.loads().values()) == 1000 and sum(more.loads().values()) == sum(sizes.values())


def test_sharding_odd_rows(tmp_path, odd, frame):
    rows = sharding.assign(odd, 3, str(tmp_path / "a")).collect()
    assert len(rows) == 11 and sum(r.size == 1 for r in rows) == 2
    assert sharding.assign(frame([]), 3, str(tmp_path / "b")).count() == 0
    placed = sharding.place(odd, 3, str(tmp_path / "c"))
    assert placed.columns == [*odd.columns, "vslot", "rebalanced_shard"] and dict(placed.dtypes)["shard"] == "int"
