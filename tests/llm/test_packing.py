"""Packing: an exact round trip of every token, the limits, and little padding."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

from evalspark.llm import packing as PK  # noqa: E402

END = 2


@pytest.fixture(scope="module")
def path():
    return P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def want_ids(tokenizer, text: str | None) -> list[int]:
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END]


def example_frame(docs):
    return docs.withColumn("segments", F.array(F.struct("text", F.lit(True).alias("loss"))))


def check_sequences(rows, limits: PK.Limits, cut: bool) -> None:
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(p.n_loss for p in pieces) <= limits.loss
        if cut and at != limits.tokens:
            assert at & (at - 1) == 0


def test_round_trip_of_documents_and_odd_rows(spark, odd, documents, path, tokenizer):
    columns = ["doc_id", "text", "n_chars"]
    docs = odd.select(*columns).unionByName(documents.select(F.col("doc_id") + 100, "text", "n_chars").toDF(*columns))
    texts = docs.select("doc_id", "text").collect()
    rows = PK.pack(example_frame(docs), path, keep=("doc_id", "n_chars")).collect()
    check_sequences(rows, PK.Limits(), True)
    got = defaultdict(list)
    for r in rows:
        assert r.loss_runs == [0, r.length] and r.n_loss == r.length and len(r.ids) == 4 * r.length
        got[r.doc_id, r.n_chars].append(r)
    want = defaultdict(list)
    for t in texts:
        want[t.doc_id, None if t.text is None else len(t.text)].append(want_ids(tokenizer, t.text))
    assert set(got) == set(want)
    for key, copies in want.items():
        pieces = sorted(got[key], key=lambda p: (p.start, p.sequence_id))
        assert {p.doc_tokens for p in pieces} == {len(c) for c in copies}
        covered = np.zeros(len(copies[0]), dtype=int)
        for p in pieces:
            covered[p.start : p.start + p.length] += 1
            ids = np.frombuffer(p.ids, dtype="<u4").tolist()
            assert any(c[p.start : p.start + p.length] == ids for c in copies)
        assert (covered == len(copies)).all()


def test_words_give_the_ids_of_whole_texts(path, tokenizer):
    texts = ["", " ", "\n\n", "Ünï Σ ΟΔΟΣ <|endoftext|>b a<|startoftext|>", "tab\tand\x1cand\x85and and end", "é ́ x́", "İ K ſ", "it's 'tis 12,345 日本 \U0001f600"]
    texts += ["long" * 1_000, "a " * 1_000 + "x" * 300, "<|STARTOFTEXT|> <|ENDOFTEXT|>A B.C(d)E'S I'M 1a2B ,'s ''S don't=\u0338 e\u0301.A\u030a", "A\u0301 E'LL x'\u0301"]
    ids = PK.WordIds(path)
    for _ in range(2):
        assert [x.tolist() for x in ids(texts)] == [want_ids(tokenizer, t)[:-1] for t in texts]


def test_words_of_equal_hashes_are_told_apart(path, tokenizer, monkeypatch):
    monkeypatch.setattr(PK, "range_hashes", lambda values, starts, ends: np.zeros(len(starts), dtype=np.uint64) + values[starts] % np.uint64(3))
    texts = ["one two three four", "two one", "ab ba abc cba"]
    assert [x.tolist() for x in PK.WordIds(path)(texts)] == [want_ids(tokenizer, t)[:-1] for t in texts]


def test_long_texts_are_taken_in_pieces(path, tokenizer, monkeypatch):
    monkeypatch.setattr(PK, "BLOCK", 20)
    texts = ["some words " * 30 + "x" * 50 + "\n\n  end ", "é" * 40, "short"]
    assert [x.tolist() for x in PK.WordIds(path)(texts)] == [want_ids(tokenizer, t)[:-1] for t in texts]


def test_the_memory_of_words_is_bounded(path, tokenizer, monkeypatch):
    monkeypatch.setattr(PK, "WORDS_KEPT", 100)
    ids = PK.WordIds(path)
    rng = random.Random(1)
    for _ in range(20):
        texts = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(30)) for _ in range(3)]
        assert [x.tolist() for x in ids(texts)] == [want_ids(tokenizer, t)[:-1] for t in texts]
        assert len(ids._hashes) == len(ids._checks) <= 100 and (np.diff(ids._hashes.astype(object)) > 0).all()


def test_the_query(spark, sf_dir, document_rows, tokenizer):
    import __spark_entry__ as entry

    rows = entry.queries()["op13_packing"](spark, sf_dir).collect()
    ids = {r[0]: want_ids(tokenizer, r[1]) for r in document_rows}
    total = defaultdict(int)
    sizes = defaultdict(int)
    for r in rows:
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        total[r.doc_id] += r.length
        sizes[r.sequence_id] += r.length
    assert total == {i: len(x) for i, x in ids.items()}
    assert all(n == 4096 or n & (n - 1) == 0 for n in sizes.values())


def turns(rng, n):
    return [(f"prompt {rng.randrange(99)} " * rng.randrange(0, 40), False) for _ in range(n)] + [("answer " * rng.randrange(0, 30), True)]


@pytest.mark.parametrize("cut", [True, False])
def test_instruction_data_under_three_limits(spark, path, tokenizer, cut):
    rng = random.Random(11)
    data = [(i, turns(rng, rng.randint(0, 3))) for i in range(300)] + [(300, []), (301, None), (302, [("p " * 3_000, False), ("a " * 900, True)])]
    limits = PK.Limits(tokens=512, segments=6, loss=128)
    df = spark.createDataFrame(data, "doc_id int, segments array<struct<text string, loss boolean>>").repartition(2)
    rows = PK.pack(df, path, limits=limits, cut=cut).collect()
    check_sequences(rows, limits, cut)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for i, segments in data:
        ids, bears = [], []
        for text, loss in segments or []:
            more = tokenizer.encode(text, add_special_tokens=False).ids
            ids, bears = ids + more, bears + [loss] * len(more)
        ids.append(END)
        bears.append(segments[-1][1] if segments else True)
        found = sorted(pieces[i], key=lambda p: p.start)
        assert [x for p in found for x in np.frombuffer(p.ids, dtype="<u4").tolist()] == ids
        got = []
        for p in found:
            mask = [False] * p.length
            for a, b in zip(p.loss_runs[0::2], p.loss_runs[1::2], strict=True):
                mask[a:b] = [True] * (b - a)
            assert sum(mask) == p.n_loss
            got += mask
        assert got == bears
        if not cut and len(ids) <= limits.tokens and sum(bears) <= limits.loss:
            assert len(found) == 1
    assert sum(r.length for r in rows) == sum(pieces[i][0].doc_tokens for i, _ in data)


def test_the_heuristic_balances_what_a_sequence_has_left():
    """Loss-heavy and loss-free examples share sequences: first fit by size would fill some with loss alone."""
    heavy = [PK.Example(np.zeros(32, dtype="<u4"), None) for i in range(32)]
    free = [PK.Example(np.zeros(96, dtype="<u4"), np.zeros(96, dtype=bool)) for i in range(32)]
    examples = heavy + free
    pool = [(i, 0, len(e.ids)) for i, e in enumerate(examples)]
    found, left = PK.sequences(examples, pool, PK.Limits(tokens=256, segments=8, loss=64), False, True)
    assert left == [] and len(found) == 16
    assert all(sorted(which // 32 for which, _, _ in s) == [0, 0, 1, 1] for s in found)


def test_empty_table_and_clashing_columns(spark, odd, path):
    packed = PK.pack(example_frame(odd.limit(0)), path)
    assert packed.collect() == []
    assert packed.columns == ["doc_id", "start", "length", "ids", "loss_runs", "n_loss", "doc_tokens", "sequence_id", "offset"]


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.booleans(), min_size=1, max_size=60), max_size=30),
    st.integers(1, 40),
    st.integers(1, 5),
    st.integers(1, 20),
    st.booleans(),
    st.booleans(),
)
def test_any_pool_is_used_up_within_the_limits(masks, tokens, segments, loss, cut, last):
    examples = [PK.Example(np.arange(len(m), dtype="<u4"), np.array(m)) for i, m in enumerate(masks)]
    limits = PK.Limits(tokens, segments, loss)
    found, left = PK.sequences(examples, [(i, 0, len(m)) for i, m in enumerate(masks)], limits, cut, last)
    seen = [np.zeros(len(m), dtype=int) for m in masks]
    for s in found:
        n = sum(b - a for _, a, b in s)
        assert 0 < n <= tokens and len(s) <= segments and sum(examples[i].loss(a, b) for i, a, b in s) <= loss
        assert not cut or n == tokens or n & (n - 1) == 0
    for i, a, b in [p for s in found for p in s] + left:
        seen[i][a:b] += 1
    assert all((x == 1).all() for x in seen)
    assert not (last and left)
    assert last or sum(b - a for _, a, b in left) < tokens
