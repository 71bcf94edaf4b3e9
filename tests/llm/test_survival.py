"""The audit of filters against applying every order to every document."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from evalspark.llm import survival as S

NUMBERS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs: list[tuple], labels: list[tuple]) -> dict[tuple, tuple]:
    """docs (doc_id, text, source), labels (doc_id, quality, toxic) -> (part, order, step) -> the numbers."""
    smallest: dict[str, int] = {}
    for i, t, _ in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    rows = defaultdict(list)
    for i, t, source in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if i is not None and smallest[t] < i:
            fails.add("E")
        rows[source or ""].append((fails, i in good, i in toxic))
    out = {}
    for part, members in rows.items():
        removed_in_all = Counter()
        for order in permutations("ABCDE"):
            alive = members
            for step, f in enumerate(order, 1):
                gone = [m for m in alive if f in m[0]]
                alive = [m for m in alive if f not in m[0]]
                removed_in_all[f] += len(gone)
                failing = sum(f in m[0] for m in members)
                alone = sum(m[0] == {f} for m in members)
                out[part, "".join(order), step] = [len(alive), len(gone), failing - len(gone), alone, sum(m[1] for m in gone), sum(m[2] for m in gone), f]
        for (p, _, _), v in out.items():
            if p == part:
                v[-1] = removed_in_all[v[-1]] if isinstance(v[-1], str) else v[-1]
    return {k: tuple(v) for k, v in out.items()}


def rows_of(df) -> dict[tuple, tuple]:
    out = {(r.part, r.filter_order, r.step): tuple(r[n] for n in NUMBERS) for r in df.collect()}
    assert len(out) == df.count()
    return out


LABELS = "doc_id long, quality int, toxic int, part string, good boolean"


def test_made_up_documents(spark, frame):
    rng = random.Random(3)
    shapes = ["word%d ", "Word%d ", "a%.0s ", "CAPS%d ", "x%d# ", "é%d\n"]
    docs = [(i, "".join(rng.choice(shapes[: rng.randint(1, 6)]) % j for j in range(rng.choice([5, 49, 50, 51, 80]))), rng.choice(["s", "t", None, ""])) for i in range(300)]
    docs += [(1000 + i, docs[rng.randrange(40)][1], "copies") for i in range(200)]  # groups of copies, and repeated rows
    docs += [(None, docs[0][1], "s"), (None, None, None), (7, None, "s"), (8, "", "t"), (7, None, "s"), (docs[5][0], docs[5][1], "t"), (9, "x " * 400_000, "long")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 400)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (99_999, 1, 1)]
    table = frame([(i, t, "en", s) for i, t, s in docs], clash=True)
    known = spark.createDataFrame([(*x, "x", True) for x in labels], LABELS)
    assert rows_of(S.audit(table, known)) == brute(docs, labels)


def test_a_text_that_most_documents_share(spark, frame):
    docs = [(i, "the same text", "s") for i in range(3_000)] + [(i, f"text {i}", "t") for i in range(3_000, 3_100)]
    got = rows_of(S.audit(frame([(i, t, "en", s) for i, t, s in docs]), spark.createDataFrame([], LABELS)))
    assert got == brute(docs, [])
    assert got["s", "EABCD", 1][:2] == (1, 2_999)


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    assert rows_of(S.audit(odd, spark.createDataFrame([(3, 1, 1, "x", True)], LABELS))) == brute(rows, [(3, 1, 1)])


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], LABELS)
    assert S.audit(frame([(1, "x", "en", "s")]).limit(0), none).collect() == []
    assert S.audit(frame([(1, "x", "en", "s")]), none).count() == 600


@given(st.lists(st.integers(0, 2**32 - 1), max_size=200))
def test_carry_save_popcounts(words):
    got = S.positional_popcounts(np.array(words, dtype=np.uint32))
    assert got.tolist() == [sum(w >> i & 1 for w in words) for i in range(32)]
