"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` consecutive words of a text the k-gram with the least hash is kept (the last one at ties). Both
sides keep the same k-gram of an equal window, so documents and benchmark share a fingerprint wherever they share
``WINDOW`` words. The fingerprints of the benchmark go to the documents as a bit filter of fixed greatest size; a
document's fingerprint that is found there is extended to the windows around it, and these are joined with the windows
of the items. A filter that is full only lets more windows through: the join decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.words import gram_hashes, joined, packs, words_of

WINDOW = 10
GRAM = 5
#: Bits of the filter: about 32 for each fingerprint, between these bounds. The greatest filter is 16 MB.
LEAST_BITS, MOST_BITS = 16, 27

_ITEM = "__item string, digest binary"
_BITS = "word long, bits long"


def winnowed(grams: np.ndarray, windows: np.ndarray, per_window: int) -> np.ndarray:
    """Positions of the k-grams that are kept: the last least one of the ``per_window`` from each of ``windows`` on."""
    if not len(windows):
        return windows
    best, at = grams[windows], windows
    for j in range(1, per_window):
        other = grams[windows + j]
        less = other <= best
        best, at = np.where(less, other, best), np.where(less, windows + j, at)
    return np.unique(at)


class _Text:
    """Words of some texts together, and which text each is in."""

    def __init__(self, texts: list[bytes]):
        self.data, begin = joined(texts)
        self.starts, self.ends, self.hashes = words_of(self.data)
        self.text = np.searchsorted(begin, self.starts, side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts))
        self.first = np.concatenate(([0], np.cumsum(self.counts)[:-1]))

    def spans(self, n: int) -> np.ndarray:
        """Positions from which n words are in one text."""
        size = max(0, len(self.text) - n + 1)
        return np.flatnonzero(self.text[:size] == self.text[n - 1 : n - 1 + size])

    def digest(self, at: int, n: int) -> bytes:
        words = [self.data[s:e].tobytes() for s, e in zip(self.starts[at : at + n], self.ends[at : at + n], strict=True)]
        return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _short(text: _Text) -> dict[int, np.ndarray]:
    """Whole items of fewer words than a window, by their number of words: their first positions."""
    return {int(n): text.first[text.counts == n] for n in np.unique(text.counts[text.counts > 0]) if n < WINDOW}


def _fingerprints(text: _Text) -> np.ndarray:
    """Kept k-grams of the long items, and whole short items."""
    grams = gram_hashes(text.hashes, GRAM)
    kept = grams[winnowed(grams, text.spans(WINDOW), WINDOW - GRAM + 1)]
    return np.concatenate([kept, *(gram_hashes(text.hashes, n)[at] for n, at in _short(text).items())])


def _filter_words(bits: int):
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch.column(0))
            for a, b in packs(texts):
                found = _fingerprints(_Text(texts[a:b]))
                places = np.concatenate((found & mask, (found >> np.uint64(32)) & mask))
                word, one = (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63))
                yield pa.record_batch([pa.array(word), pa.array(one.view(np.int64))], names=["word", "bits"])

    return run


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, ids = _bytes(batch.column(0)), batch.column(1).to_pylist()
        for a, b in packs(texts):
            text = _Text(texts[a:b])
            rows = [(i, WINDOW) for i in text.spans(WINDOW)] + [(i, n) for n, at in _short(text).items() for i in at]
            items = [ids[a + text.text[i]] for i, _ in rows]
            digests = [text.digest(i, n) for i, n in rows]
            yield pa.record_batch([pa.array(items, pa.string()), pa.array(digests, pa.binary())], names=["__item", "digest"])


def _document_hits(filter_bits: np.ndarray, bits: int, short: list[int]):
    """For each text: its number of words, and the windows around the fingerprints that the filter has."""
    mask = np.uint64((1 << bits) - 1)
    hit_type = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("digest", pa.binary())]))

    def known(prints: np.ndarray) -> np.ndarray:
        out = np.ones(len(prints), dtype=bool)
        for place in (prints & mask, (prints >> np.uint64(32)) & mask):
            out &= (filter_bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return out

    def windows(text: _Text) -> Iterator[tuple[int, int]]:
        grams, whole = gram_hashes(text.hashes, GRAM), text.spans(WINDOW)
        kept = winnowed(grams, whole, WINDOW - GRAM + 1)
        hits = kept[known(grams[kept])]
        around = np.unique((hits[:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
        yield from ((i, WINDOW) for i in np.intersect1d(around, whole, assume_unique=True).tolist())
        for n in short:
            spans = text.spans(n)
            yield from ((i, n) for i in spans[known(gram_hashes(text.hashes, n)[spans])].tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch.column("__text"))
            n_words, hits = np.zeros(len(texts), dtype=np.int64), [[] for _ in texts]
            for a, b in packs(texts):
                text = _Text(texts[a:b])
                n_words[a:b] = text.counts
                for i, n in windows(text):
                    to = int(text.text[i])
                    hits[a + to].append({"start": i - int(text.first[to]), "words": n, "digest": text.digest(i, n)})
            kept = batch.drop_columns(["__text"])
            columns = [*kept.columns, pa.array(n_words), pa.array(hits, hit_type)]
            yield pa.record_batch(columns, names=[*kept.schema.names, "n_words", "hits"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per document: the columns ``keep``, n_words, n_hit (words in occurrences of item windows), items.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. A window is ``WINDOW`` consecutive words
    of an item; an item of fewer words, but not none, is one window. ``items`` is the sorted array of the ids, as text,
    of items with a window that occurs. Every occurrence is found. Null and empty texts have no words and no hits;
    repeated documents get a row each; items of equal id count once; a null item id is an empty text. An empty
    benchmark leaves every document without hits, an empty table of documents gives no rows. Other columns are ignored.

    The documents pass Python once and leave as their hits; a bit filter of at most 2**27 bits is what each task gets
    of the benchmark. The windows are joined by a 128-bit digest of their words.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(text).alias("__text"), F.coalesce(F.col(item).cast("string"), F.lit("")).alias("__item"))
    texts = items.select("__text")
    size = texts.agg(F.sum(F.octet_length("__text"))).first()[0] or 0  # a fingerprint for each few words, of two bytes at least
    bits = min(MOST_BITS, max(LEAST_BITS, (size * 4).bit_length()))
    filled = texts.mapInArrow(_filter_words(bits), _BITS).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    filter_bits = np.zeros(1 << (bits - 6), dtype=np.uint64)
    for r in filled.toLocalIterator():  # at most as many rows as the filter has words
        filter_bits[r.word] = np.uint64(r.bits & 0xFFFFFFFFFFFFFFFF)
    lengths = items.mapInArrow(_item_windows_lengths, "n int").distinct().collect()  # at most WINDOW - 1 rows
    short = sorted(r.n for r in lengths)

    keys = [f"__k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, keys, strict=True)], F.col(text).alias("__text"))
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    found = rows.mapInArrow(
        _document_hits(filter_bits, bits, short), f"{fields}, n_words long, hits array<struct<start: int, words: int, digest: binary>>"
    )
    found = found.withColumn("hit", F.explode_outer("hits")).drop("hits")
    # A document without hits gets a key that no window has, so that these rows do not meet in one task.
    found = found.withColumn("digest", F.coalesce(F.col("hit.digest"), F.encode(F.lpad(F.col("__row").cast("string"), 20, "0"), "UTF-8")))
    windows = items.select("__text", "__item").mapInArrow(_item_windows, _ITEM)
    windows = windows.groupBy("digest").agg(F.collect_set("__item").alias("__items"))
    hit = F.when(F.col("__items").isNotNull(), F.struct(F.col("hit.start").alias("a"), (F.col("hit.start") + F.col("hit.words")).alias("b")))
    joined_rows = found.join(windows, "digest", "left").withColumn("__hit", hit)
    per_doc = joined_rows.groupBy("__row", *keys, "n_words").agg(
        F.sort_array(F.collect_list("__hit")).alias("__hits"), F.array_distinct(F.flatten(F.collect_set("__items"))).alias("__all")
    )
    covered = F.aggregate(
        "__hits",
        F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")),
        lambda acc, h: F.struct(
            F.greatest(acc["to"], h["b"]).alias("to"), (acc["n"] + F.greatest(F.lit(0), h["b"] - F.greatest(acc["to"], h["a"]))).alias("n")
        ),
        lambda acc: acc["n"],
    )
    return per_doc.select(*[F.col(k).alias(c) for c, k in zip(keep, keys, strict=True)], "n_words", covered.alias("n_hit"), F.sort_array("__all").alias("items"))


def _item_windows_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _bytes(batch.column(0))
        for a, b in packs(texts):
            yield pa.record_batch([pa.array(list(_short(_Text(texts[a:b]))), pa.int32())], names=["n"])
