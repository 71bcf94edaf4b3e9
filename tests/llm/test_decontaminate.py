from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from evalspark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (of := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= of
        out.append((doc_id, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def found(docs, benchmark):
    rows = decontaminate.contamination(docs, benchmark).collect()
    return sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows], key=repr)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("digest", F.lit(1))


def test_given_tables(spark, sf_dir, documents, document_rows):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = brute_force([r[:2] for r in document_rows], [(r.item_id, r.text) for r in benchmark.collect()])
    assert found(documents, benchmark) == want
    assert any(n for _, _, n, _ in want)


def test_short_items_overlaps_and_edges_of_texts(spark, frame):
    line = " ".join(f"w{i % 7}" for i in range(60))
    items = [(1, line), (2, "Two words"), (3, "one"), (4, None), (5, "!!"), (6, "a b c d e f g h i"), (7, "a b c d e f g h i j"), (None, "two, words!"), (7, "other text of this very item that has more than ten words in it")]
    texts = [line, "x " + line + " y", "one", "ONE-one", "two words two words", "two two words", "a b c d e f g h i", "a b c d e f g h i j", "z a b c d e f g h i j k", "a b c d e f g h j i", "", None,
             "of this very item that has more than ten words", "item that has more than ten words in it two", "a " * 30 + "two words" + " b" * 30]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    assert found(frame(rows, clash=True), items_frame(spark, items)) == brute_force(enumerate(texts), items)


def test_odd_rows(spark, odd):
    items = [(1, "long " * 12), (2, "x" * 1_500_000), (3, "the same text twice and the same id"), (4, "k i̇")]
    want = brute_force([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()], items)
    assert found(odd, items_frame(spark, items)) == want


def test_empty_tables(spark, odd, frame):
    assert found(frame([]), items_frame(spark, [(1, "a b")])) == []
    assert all(not n and not i for _, _, n, i in found(odd, items_frame(spark, [])))


@pytest.mark.parametrize("n", [9, 10, 11, 25])
def test_a_shared_span_of_a_window_is_always_found(spark, frame, n):
    span = " ".join(f"s{i}" for i in range(n))
    rows = [(i, " ".join(f"p{i}x{j}" for j in range(i)) + " " + span + " tail", None, None) for i in range(40)]
    got = found(frame(rows), items_frame(spark, [(1, "before it " + span + " after it all that")]))
    assert {h for _, _, h, _ in got} == {n if n >= 10 else 0}
