from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from evalspark.llm import langid


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = langid.learn(docs.filter(~held_out))
    assert model.langs == ["de", "en", "es", "fr"]
    rows = langid.predict(docs.filter(held_out), model, keep=("doc_id", "lang")).collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) > 250 and right / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_known_words_come_first_then_the_longest_known_grams():
    model = langid.Model.fit([("aa", "water", 50), ("bb", "water", 1), ("bb", "wasser", 50), ("aa", "single", 1)], ["bb", "aa"])
    assert np.argmax(model.score_of("water")) == 0 and np.argmax(model.score_of("wasser")) == 1
    assert "single" not in model.words  # too rare to be known
    longest = [g for g in model._cut("singles", 5) if g in model.grams]
    assert np.allclose(model.score_of("singles"), model.table[[model.grams[g] for g in longest]].mean(axis=0))
    assert not model.score_of("中").any()


def test_scores_do_not_depend_on_the_cache_or_the_slices(monkeypatch):
    model = langid.Model.fit([("aa", f"w{c}ord", 3) for c in "abcdef"] + [("bb", f"x{c}ord", 3) for c in "abcdef"], ["aa", "bb"])
    text = " ".join(["waord", "xbord", "wcord", "unwaords", "waord7x"] * 50)
    want = model.predict(text)
    monkeypatch.setattr(langid, "_CACHE", 2)
    monkeypatch.setattr(langid, "_SLICE", 7)
    fresh = langid.Model(model.langs, model.words, model.grams, model.table)
    got = fresh.predict(text)
    assert got[0] == want[0] == "aa" and abs(got[1] - want[1]) < 1e-9


def test_odd_rows(odd, frame, documents):
    model = langid.learn(documents, rows_per_lang=20)
    rows = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(odd, model).collect()]
    assert len(rows) == 11
    for doc_id, lang, score in rows:
        assert (lang == "und") == (doc_id in (1, 2, 4)) and 0 <= score <= 1
    assert langid.predict(frame([]), model).count() == 0
    nothing = langid.learn(frame([(1, "no label here", None, None)]))
    assert nothing.langs == [] and {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}
    assert langid.learn(frame([])).langs == []


def test_the_model_is_bounded(documents):
    model = langid.learn(documents, rows_per_lang=5, model_words=400, max_langs=3)
    assert len(model.langs) == 3 and len(model.words) <= 400


def brute_score(counts, langs, word):
    """The word's log frequencies, else the mean of those of its longest n-grams that any word has."""

    def table(of):
        names = sorted({name for _, name in of})
        total = {lang: sum(of.get((lang, name), 0) for name in names) for lang in langs}
        return lambda name: [np.log(of.get((lang, name), 0) + langid.SMOOTHING) - np.log(total[lang] + langid.SMOOTHING * max(1, len(names))) for lang in langs]

    rare = {w for w in {w for _, w, _ in counts} if sum(n for _, x, n in counts if x == w) < langid.LEAST_COUNT}
    words = {(lang, w): n for lang, w, n in counts if w not in rare}
    if word in {w for _, w in words}:
        return table(words)(word)
    for size in langid.GRAMS:
        grams: dict = {}
        for lang, w, n in counts:
            for g in {f"^{w}$"[i : i + size] for i in range(len(w) + 3 - size)} if size > 1 else set(w):
                grams[lang, g] = grams.get((lang, g), 0) + n
        own = [f"^{word}$"[i : i + size] for i in range(len(word) + 3 - size)] if size > 1 else list(word)
        own = [g for g in own if g in {g for _, g in grams}]
        if own:
            return np.mean([table(grams)(g) for g in own], axis=0).tolist()
    return [0.0] * len(langs)


def test_scores_against_plain_python():
    counts = [("aa", "water", 5), ("bb", "water", 1), ("bb", "wasser", 7), ("aa", "house", 2), ("cc", "haus", 3), ("cc", "rare", 1)]
    langs = ["aa", "bb", "cc"]
    model = langid.Model.fit(counts, langs)
    for word in ("water", "wasser", "rare", "hauswater", "housing", "zzz", "h", "wa"):
        assert np.allclose(model.score_of(word), brute_score(counts, langs, word))


def test_every_language_is_learned(spark, frame):
    word = lambda lang, k: "w" + chr(97 + lang // 26) + chr(97 + lang % 26) + "x" * k
    rows = [(i, " ".join(word(lang, k) for k in range(8)), f"l{lang:03}", None) for i, lang in enumerate(x for x in range(300) for _ in range(2))]
    docs = frame(rows)
    model = langid.learn(docs)
    assert len(model.langs) == 300
    found = langid.predict(docs, model, keep=("doc_id", "lang")).collect()
    assert all(r.lang == r.lang_pred for r in found)


def test_the_model_is_bounded_in_words_and_grams(documents):
    model = langid.learn(documents, model_cells=8_000)
    assert model.table.size <= 8_000 and len(model.words) <= 1_000 and model.grams and len(model.langs) == 4
    assert {len(g) for g in model.grams} >= {1, 2}
    some = documents.limit(50)
    rows = langid.predict(some, model, keep=("lang",)).collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 40
