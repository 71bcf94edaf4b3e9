"""Alignment of two tokenizers against a version that looks at every byte."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

P = pytest.importorskip("public_tokenizers")

from evalspark.llm import alignment as AL  # noqa: E402

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
TEXTS = [
    "plain words, and some more",
    " leading space",
    "  two spaces  and\ttabs\n\nlines ",
    "é 𝔘𝔫𝔦 日本語 \U0001f600\U0001f600 ﷽ İ",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "a▁b holds the mark of a space",
    "\x00\x01 control",
    "aaaa" * 50,
    ".",
]


@pytest.fixture(scope="module")
def paths():
    return P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def brute(texts: list[str | None], paths) -> list[tuple]:
    """Every byte belongs to one token of each tokenizer; the pairs of owners are the links."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=paths[1])
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(x): x for x in printable} | {chr(256 + n): x for n, x in enumerate(sorted(set(range(256)) - set(printable)))}

    def piece(i: int) -> bytes:
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    docs = []
    for t in texts:
        found = None
        if t:
            data = (" " + t).encode()
            ids = [a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)]
            entries = [[bytes(of[c] for c in a.id_to_token(i)) for i in ids[0]], [piece(i) for i in ids[1]]]
            if all(b"".join(e) == data for e in entries):
                owners = [[n for n, e in enumerate(side) for _ in e] for side in entries]
                links = sorted(set(zip(*owners, strict=True)))
                ends = [{sum(len(e) for e in side[: n + 1]): n for n in range(len(side))} for side in entries] if len(data) < 5_000 else None
                found = (ids, links, ends)
        docs.append(found)
    counts = Counter((d[0][0][i], d[0][1][j]) for d in docs if d for i, j in d[1])
    best: dict[int, int] = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, "", 0, 0))
            continue
        ids, links, ends = d
        of_links = [counts[ids[0][i], ids[1][j]] for i, j in links]
        n_best = sum(n == best[ids[1][j]] for n, (_, j) in zip(of_links, links, strict=True))
        groups = None
        if ends is not None:
            groups, at = [], [0, 0]
            for cut in sorted(set(ends[0]) & set(ends[1])):
                to = [ends[0][cut] + 1, ends[1][cut] + 1]
                groups.append("|".join(",".join(map(str, ids[k][at[k] : to[k]])) for k in (0, 1)))
                at = to
        out.append((len(ids[0]), len(ids[1]), len(ids[0]) + len(ids[1]) - len(links), len(links), groups and ";".join(groups), n_best, sum(of_links)))
    return out


def same(got: list[tuple], want: list[tuple]) -> None:
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert (g if w[4] is not None else g[:4] + (None,) + g[5:]) == w


def test_documents_and_odd_texts(spark, frame, document_rows, paths):
    texts = [None, "", *TEXTS, TEXTS[0], *[r[1] for r in document_rows]]
    docs = frame([(i, t, "en", "s") for i, t in enumerate(texts)], clash=True)
    got = AL.align(docs, *paths, block_links=2_000).orderBy("doc_id").select(*COLUMNS).collect()
    same([tuple(r) for r in got], brute(texts, paths))


def test_the_query_has_the_digest_of_the_groups(spark, sf_dir, document_rows, paths):
    import __spark_entry__ as entry

    got = {r.doc_id: r.groups_sha256 for r in entry.queries()["op11_alignment"](spark, sf_dir).collect()}
    want = brute([r[1] for r in document_rows], paths)
    checked = 0
    for r, w in zip(document_rows, want, strict=True):
        if w[4] is not None:
            assert got[r[0]] == (hashlib.sha256(w[4].encode()).hexdigest() if w[0] else "")
            checked += 1
    assert checked > 100


def test_texts_are_cut_without_a_trace(spark, frame, paths, monkeypatch):
    rng = random.Random(5)
    words = ["alpha", "Beta", "x1", "don't", "naïve", "日本", "...", "\n", "I", "\U0001f600", "  ", "\t", "\x1c", "\xa0", "'s", "1", "\u3000", "▁", "a▁"]
    texts = [" ".join(rng.choice(words) for _ in range(120_000)), "ab" * 200_000]
    for _ in range(300):
        texts.append("".join(rng.choice([*words, " ", " ", "\n", "\r\n"]) for _ in range(rng.randrange(12))))
    want = brute(texts, paths)
    monkeypatch.setattr(AL, "PARTS_KEPT", 50)
    docs = frame([(i, t, "en", "s") for i, t in enumerate(texts)])
    got = AL.align(docs, *paths).orderBy("doc_id").select(*COLUMNS).collect()
    same([tuple(r) for r in got], want)
    assert sum(w[0] == 0 for w in want) > 50 and sum(w[0] > 0 for w in want) > 100


def test_other_vocabularies_leave_texts_whole(paths):
    align = AL.Aligner(*paths)
    assert align.a.cuttable and align.b.cuttable
    assert align.parts("one two\nthree  four") == [" one", " two", "\nthree  four"]
    align.b.cuttable = False
    assert align.parts("one two") == [" one two"]


def test_repeated_rows_and_other_columns(spark, odd, paths):
    got = AL.align(odd, *paths, keep=("doc_id", "n_chars")).collect()
    assert len(got) == odd.count()
    assert all((r.n_a == 0) == (r.groups == "") for r in got)
    by_id = [r for r in got if r.doc_id == 3 and r.n_chars == len("the same text twice and the same id")]
    assert len(by_id) == 2 and by_id[0] == by_id[1]


def test_empty_table(spark, frame, paths):
    assert AL.align(frame([(1, "x", "en", "s")]).limit(0), *paths).collect() == []
