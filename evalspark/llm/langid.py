"""Language identification, words first: a known word scores by its log frequency in each language, an unseen word by its
longest known character n-grams."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The sample that is learned from: labelled rows of each language, on average.
ROWS_PER_LANG = 2_000
#: Words of the model in all; a language has its share.
MODEL_WORDS = 400_000
#: Numbers in the model, one for each language of each word and n-gram: words have half of them at most, n-grams what is
#: left, the shorter before the longer and the frequent before the rare. With many languages this is the bound.
MODEL_CELLS = 20_000_000
LEAST_COUNT = 2
GRAMS = (5, 4, 3, 2, 1)
SMOOTHING = 0.5
UNKNOWN = "und"
_CACHE = 200_000
_SLICE = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")
_GAP = re.compile(r"[\W\d_]")


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-cased words of the whole text, in slices that end between words."""
    text = text.lower()
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + _SLICE) if at + _SLICE < len(text) else None
        end = gap.end() if gap else len(text)
        yield _WORD.findall(text, at, end)
        at = end


@dataclass
class Model:
    """Log frequencies by language for words and n-grams. Bounded by ``MODEL_CELLS`` numbers, whatever was learned from."""

    langs: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    table: np.ndarray = field(default_factory=lambda: np.zeros((1, 0)))
    _known: dict[str, list[int]] = field(default_factory=dict, repr=False)

    @classmethod
    def fit(cls, counts: Iterable[tuple[str, str, int]], langs: list[str], cells: int = MODEL_CELLS) -> Model:
        """``counts``: (language, word, occurrences), each pair of language and word once. They are held as they come; n-grams
        are noted size by size, as two numbers for each of a word's. The table of all languages has ``cells`` numbers at
        most."""
        langs = sorted(langs)
        of = {lang: i for i, lang in enumerate(langs)}
        model, width = cls(langs), len(langs)
        words: list[str] = []
        spoken, times = array("i"), array("d")
        for lang, word, n in counts:
            words.append(word)
            spoken.append(of[lang])
            times.append(n)
        spoken, times = np.array(spoken, dtype=np.int32), np.array(times)
        tables, first = [np.zeros((0, width))], 0
        left = cells // max(1, width)
        for kind in (0, *sorted(GRAMS)) if words else ():
            names: dict[str, int] = {}
            rows, of_word = array("i"), array("i")
            for i, word in enumerate(words):
                for name in (word,) if kind == 0 else set(cls._cut(word, kind)):
                    rows.append(names.setdefault(name, len(names)))
                    of_word.append(i)
            row, which = np.frombuffer(rows, dtype=np.int32), np.frombuffer(of_word, dtype=np.int32)
            total = np.bincount(row, weights=times[which], minlength=len(names))
            kept = np.flatnonzero(total >= (LEAST_COUNT if kind == 0 else 0))
            room = left // 2 if kind == 0 else left
            if len(kept) > room:  # the most frequent, the first of equal ones
                kept = np.sort(kept[np.argsort(-total[kept], kind="stable")[:room]])
            left -= len(kept)
            at = np.full(len(names), -1)
            at[kept] = np.arange(len(kept))
            use = at[row] >= 0
            cell = at[row[use]] * width + spoken[which[use]]
            found = np.bincount(cell, weights=times[which[use]], minlength=len(kept) * width).reshape(len(kept), width)
            into = model.words if kind == 0 else model.grams
            into.update((name, first + int(at[i])) for name, i in names.items() if at[i] >= 0)
            tables.append(np.log(found + SMOOTHING) - np.log(found.sum(axis=0) + SMOOTHING * max(1, len(kept))))
            first += len(kept)
        model.table = np.concatenate(tables)
        return model

    @staticmethod
    def _cut(word: str, size: int) -> list[str]:
        if size == 1:
            return list(word)
        padded = f"^{word}$"
        return [padded[i : i + size] for i in range(len(padded) - size + 1)]

    def rows_of(self, word: str) -> list[int]:
        """Rows of the table whose mean is the word's score: its own, else those of its longest n-grams that are known."""
        if (row := self.words.get(word)) is not None:
            return [row]
        for size in GRAMS:
            if rows := [r for g in self._cut(word, size) if (r := self.grams.get(g)) is not None]:
                return rows
        return []

    def score_of(self, word: str) -> np.ndarray:
        rows = self.rows_of(word)
        return self.table[rows].mean(axis=0) if rows else np.zeros(len(self.langs))

    def predict(self, text: str) -> tuple[str, float]:
        """(language, posterior probability); ``und`` and 0 without a letter or without a language to choose."""
        total, letters = np.zeros(len(self.langs)), False
        for words in words_of(text):
            rows: list[int] = []
            weights: list[float] = []
            for word, n in Counter(words).items():
                if (own := self._known.get(word)) is None:
                    if len(self._known) >= _CACHE:
                        self._known.clear()
                    own = self._known[word] = self.rows_of(word)
                rows += own
                weights += [n / len(own)] * len(own) if own else own
                letters = letters or any(c.isalpha() for c in word)
            if rows:
                total += np.array(weights) @ self.table[rows]
        if not letters or not self.langs:
            return UNKNOWN, 0.0
        best = int(np.argmax(total))
        return self.langs[best], float(1.0 / np.exp(np.minimum(total - total[best], 0.0)).sum())


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for words in words_of(text.as_py() or ""):
                counts.update((lang, w) for w in words)
        langs, words = zip(*counts, strict=True) if counts else ((), ())
        yield pa.record_batch([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], names=["lang", "word", "n"])


def learn(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows_per_lang: int = ROWS_PER_LANG,
    max_langs: int | None = None,
    model_words: int = MODEL_WORDS,
    model_cells: int = MODEL_CELLS,
) -> Model:
    """A model from a bounded sample of the labelled rows: of each language the rows whose hash of key and text is in the
    share of all hashes that holds ``rows_per_lang`` rows (give or take chance; all rows of a smaller language). All
    languages are learned, or the ``max_langs`` with most rows if that is given. Nothing is ranked: only counts by
    language meet in one task. Rows without a language or a text teach nothing; without labelled rows the model has no
    language. Whole texts are counted, in Spark; what reaches the driver is the languages and the most frequent words,
    ``model_words`` in all, and the model is ``model_cells`` numbers at most: with more languages it has fewer words and n-grams of each.
    """
    rows = docs.filter(F.col(lang).isNotNull()).select(F.xxhash64(F.col(key), F.col(text)).alias("h"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    sizes = (sizes if max_langs is None else sizes.limit(max_langs)).collect()
    langs = [r.lang for r in sizes]
    most = [(r.lang, min(2**63 - 1, 2**64 * rows_per_lang // r.n - 2**63)) for r in sizes]
    bound = F.broadcast(rows.sparkSession.createDataFrame(most, "lang string, most long"))  # a row for each language
    sample = rows.join(bound, "lang").filter(F.col("h") <= F.col("most")).select("lang", "text")
    counts = sample.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = min(model_words, model_cells // (2 * max(1, len(langs))))
    share = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.withColumn("r", F.row_number().over(share)).filter(F.col("r") <= max(1, words // max(1, len(langs))))
    return Model.fit(map(tuple, top.select("lang", "word", "n").toLocalIterator()), langs, model_cells)


def predict(
    docs: DataFrame, model: Model, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", into: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """One row per document: the columns ``keep``, and language and score (0 to 1) as the columns ``into``.

    Null, empty and letterless texts are ``und`` with score 0; so is every text of a model without languages. Equal texts
    get equal results. Ties go to the language that sorts first. An empty table gives no rows. Other columns are
    ignored. One pass, no shuffle.
    """
    rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)])
    if text not in keep:  # a text that is kept is not sent twice
        rows = docs.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)], F.col(text).alias("__text"))
    body = f"__k{keep.index(text)}" if text in keep else "__text"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by model_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py() or "") for t in batch.column(body)]
            kept = batch.drop_columns(["__text"]) if body == "__text" else batch
            columns = [*kept.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.record_batch(columns, names=[*kept.schema.names, "lang_pred", "score"])

    found = rows.mapInArrow(run, f"{fields}, lang_pred string, score double")
    return found.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], F.col("lang_pred").alias(into[0]), F.col("score").alias(into[1]))
