"""Alignment of two tokenizers over the same texts, and how often their ids meet in the corpus.

Both tokenizers state where in the text a token stands: the one of ``tokenizers`` in characters, sentencepiece's proto in
bytes. These spans are coarse cuts: tokens that share a character, and bytes that stand for an unknown one, have the
span of the whole character or an empty one, and the space that sentencepiece puts before a text is in no span. A token
whose span has as many bytes as it decodes to ends where its span ends; the others are counted on from there by the
bytes they decode to. Ends of both tokenizers that fall together cut the tokens into groups, and the stretches between
any two neighbouring ends are the links: each is the overlap of just one token with one other.

A text is cut before every single space or line feed between two other characters: there both tokenizers start a token, whatever
comes before or after (which is checked for the vocabularies at hand; for others texts stay whole). The parts between these
cuts are mostly words. Parts a task has not met yet are tokenized together, many to a call, and what was found is
remembered for each: its tokens, groups and links. A text is the sum of its parts.

Tokens are made once. A task numbers the pairs of ids in blocks of about ``BLOCK_LINKS`` links and notes for each document which
numbers it has how often, and for each block its pairs, so that a pair which all documents share is counted by a row
for each block instead of one for each link. The corpus-wide counts go back to the blocks the same way and each
block's documents look their numbers up in them.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.llm.order import stored
from evalspark.llm.words import packs

BLOCK_LINKS = 1 << 21
BLOCK_ROWS = 1 << 16
#: Characters of new parts in one text to encode (longer ones take longer by the character), and such texts at a time.
TEXT_CHARS = 1 << 12
TEXTS = 1 << 6
#: Parts that a task remembers, of at most so many characters. The memory is emptied when it is full.
PARTS_KEPT = 600_000
LONG_PART = 64

_BLOCK_BITS = 24  # block: task above, block of the task below
_PAIRS_IN_ROW = 1 << 16
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


class TokenizerA:
    """A byte-level tokenizer file: ids, and spans in bytes, of texts as they stand."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has a core, not the machine
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        names = self._tokenizer.get_vocab(with_added_tokens=True)
        byte = _bytes_of_characters()
        added = {t.content for t in self._tokenizer.get_added_tokens_decoder().values()}
        self.entries = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.entries[i] = name.encode() if name in added else bytes(byte[c] for c in name)
        rules = json.loads(self._tokenizer.to_str())
        words = rules["pre_tokenizer"] or {}
        self.cuttable = rules["normalizer"] is None and words.get("type") == "ByteLevel" and words.get("use_regex") and not words.get("add_prefix_space")

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each text the ids, and the ends of their spans in bytes; a span starts where the one before ends, or in the
        same character."""
        for text, e in zip(texts, self._tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            ends = np.array([end for _, end in e.offsets], dtype=np.int64)
            if not text.isascii():
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                ends = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))[ends]
            yield np.array(e.ids, dtype=np.int64), ends


class TokenizerB:
    """A sentencepiece model with byte fallback: ids, and spans in bytes, of texts whose first space it adds itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self._model.get_piece_size()
        names = self._model.id_to_piece(list(range(n)))
        self.entries = [bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.cuttable = not any("▁" in p.lstrip("▁") or "\n" in p or " " in p for p in names)

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each text, which begins with a space, the ids and the ends of their spans in bytes."""
        for proto in self._model.encode([t[1:] for t in texts], return_type="proto", num_threads=1):
            flat = np.array([x for p in proto.pieces for x in (p.id, p.end)], dtype=np.int64)
            yield flat[0::2], flat[1::2] + 1


def _bytes_of_characters() -> dict[str, int]:
    """The usual byte-level alphabet: printable bytes stand for themselves, the others for characters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + n): b for n, b in enumerate(others)}}


class _Vocabulary:
    """Entries of a tokenizer: their bytes, their lengths, and their ids as text with what follows in the list of groups."""

    def __init__(self, tokenizer: TokenizerA | TokenizerB):
        self.encode, self.entries, self.cuttable = tokenizer, tokenizer.entries, tokenizer.cuttable
        self.lengths = np.array([len(e) for e in self.entries], dtype=np.int64)
        self.written = np.array([[f"{i}{after}" for i in range(len(self.entries))] for after in (",", "|", ";")], dtype=object)
        self.digits = np.array([len(w) for w in self.written[0]], dtype=np.int64)

    def ends(self, texts: list[str], data: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the texts, one after another, and where each ends in their bytes; None if they do not decode to them."""
        found = list(self.encode(texts))
        ids = np.concatenate([f[0] for f in found])
        if b"".join(map(self.entries.__getitem__, ids.tolist())) != data:
            return None
        shift = np.cumsum([0, *(len(t.encode()) for t in texts[:-1])])
        spans = np.concatenate([f[1] + at for f, at in zip(found, shift.tolist(), strict=True)])
        ends = refined(spans, self.lengths[ids])
        if np.any(np.diff(ends, prepend=0) <= 0) or ends[-1] != len(data):
            raise ValueError("spans and decoded bytes of a tokenizer contradict each other")
        return ids, ends


def refined(spans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes: where its span ends if that holds as many bytes as the token decodes to, else
    counted on from the last such end by decoded bytes."""
    decoded = np.cumsum(lengths)
    sure = np.maximum.accumulate(np.where(np.diff(spans, prepend=0) == lengths, np.arange(len(lengths)), -1))
    return decoded + np.where(sure >= 0, spans[sure] - decoded[sure], 0)


#: Tokens of A and of B, of each link the ids of A and B as one 64-bit number, and the groups as text.
Part = tuple[int, int, bytes, str]


class Aligner:
    """Parts of texts aligned, and remembered."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _Vocabulary(TokenizerA(path_a)), _Vocabulary(TokenizerB(path_b))
        self._known: dict[str, Part | None] = {}
        self._before: dict[str, Part | None] = {}

    def parts(self, text: str) -> list[str]:
        """What a space and the text are cut into."""
        return _CUT.split(" " + text) if self.a.cuttable and self.b.cuttable else [" " + text]

    def __call__(self, texts: list[list[str]]) -> list[list[Part | None]]:
        """Of texts that are cut into parts what each part holds; None for parts that do not come back.

        What is remembered is of two ages: parts that are met again become young, and the old ones go when the young
        ones are many.
        """
        missing = set().union(*texts).difference(self._known)
        for p in missing & self._before.keys():
            self._known[p] = self._before[p]
        new = missing.difference(self._before)
        # Only a part that begins with one space or line feed, and does not end in white space, can stand among others.
        plain = [p for p in new if p[0] in " \n" and len(p) > 1 and not p[1].isspace() and not p[-1].isspace()]
        for some in _texts_of(plain):
            self._align_some(some)
        for p in new.difference(plain):
            self._align_alone(p)
        out = [list(map(self._known.__getitem__, parts)) for parts in texts]
        for p in new:
            if len(p) > LONG_PART:
                del self._known[p]
        if len(self._known) > PARTS_KEPT // 2:
            self._known, self._before = {}, self._known
        return out

    def _align_some(self, texts: list[list[str]]) -> None:
        found = self._aligned([[" x", *parts] for parts in texts])
        if found is not None:
            for parts, each in zip(texts, found, strict=True):
                self._known.update(zip(parts, each[1:], strict=True))
        elif len(texts) > 1:  # one of them does not come back
            self._align_some(texts[: len(texts) // 2])
            self._align_some(texts[len(texts) // 2 :])
        elif len(texts[0]) > 1:
            half = len(texts[0]) // 2
            self._align_some([texts[0][:half]])
            self._align_some([texts[0][half:]])
        else:
            self._known[texts[0][0]] = None

    def _align_alone(self, part: str) -> None:
        found = self._aligned([[part] if part[0] == " " else [" x", part]])
        self._known[part] = None if found is None else found[0][-1]

    def _aligned(self, texts: list[list[str]]) -> list[list[Part]] | None:
        joined = ["".join(parts) for parts in texts]
        data = "".join(joined).encode()
        a, b = self.a.ends(joined, data), self.b.ends(joined, data)
        if a is None or b is None:
            return None
        (ids_a, ends_a), (ids_b, ends_b) = a, b
        sizes = [len(p) if p.isascii() else len(p.encode()) for parts in texts for p in parts]
        cuts = np.cumsum(sizes)
        # By byte: whether a token of A, of B ends there. Running sums number tokens, links and groups.
        is_a, is_b = np.zeros(len(data) + 1, dtype=bool), np.zeros(len(data) + 1, dtype=bool)
        is_a[ends_a] = is_b[ends_b] = True
        common, either = is_a & is_b, np.flatnonzero(is_a | is_b)
        if not common[cuts].all():
            raise ValueError("a token reaches over a cut between two parts")
        of_a, of_b, of_link, of_group = (np.cumsum(x, dtype=np.int64) for x in (is_a, is_b, is_a | is_b, common))
        # The token that a link ends in, or with: as many have ended before.
        pairs = (ids_a[of_a[either] - is_a[either]] << 32 | ids_b[of_b[either] - is_b[either]]).tobytes()
        # Written out group by group: the ids of A, then those of B. Each is followed by one character.
        groups = np.flatnonzero(common)
        written = np.empty(len(ids_a) + len(ids_b), dtype=object)
        width = np.empty(len(written), dtype=np.int64)
        at_a = np.arange(len(ids_a)) + np.append(0, of_b[groups])[of_group[ends_a] - common[ends_a]]
        at_b = np.arange(len(ids_b)) + of_a[groups][of_group[ends_b] - common[ends_b]]
        written[at_a], width[at_a] = self.a.written[np.where(common[ends_a], 1, 0), ids_a], self.a.digits[ids_a]
        written[at_b], width[at_b] = self.b.written[np.where(common[ends_b], 2, 0), ids_b], self.b.digits[ids_b]
        text = "".join(written.tolist())
        to_char = np.append(0, np.cumsum(width))[of_a[cuts] + of_b[cuts]]
        edges = [np.append(0, x).tolist() for x in (of_a[cuts], of_b[cuts], of_link[cuts], to_char)]
        every = zip(*[e[i : len(e) - 1 + i] for e in edges for i in (0, 1)], strict=True)
        flat = [(na - ma, nb - mb, pairs[8 * ml : 8 * nl], text[mc : nc - 1]) for ma, na, mb, nb, ml, nl, mc, nc in every]
        at = np.cumsum([0, *map(len, texts)]).tolist()
        return [flat[i:j] for i, j in zip(at, at[1:])]


def _texts_of(parts: list[str]) -> Iterator[list[list[str]]]:
    """Parts in lists of TEXT_CHARS characters, TEXTS lists at a time; a longer part is a list of its own."""
    some: list[list[str]] = []
    size = TEXT_CHARS
    for p in parts:
        size += len(p)
        if size > TEXT_CHARS:
            if len(some) == TEXTS:
                yield some
                some = []
            some.append([])
            size = len(p)
        some[-1].append(p)
    if some:
        yield some


@lru_cache(maxsize=4)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers with all their low bytes first, then the next ones: small numbers compress to about a byte."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_MADE = pa.schema(
    [
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups", pa.string()),
        ("block", pa.int64()),
        ("numbers", pa.binary()),
        ("times", pa.binary()),
        ("first", pa.int32()),
        ("pairs", pa.list_(pa.int64())),
        ("links", pa.list_(pa.int64())),
    ]
)
_MADE_DDL = (
    "n_a long, n_b long, n_groups long, n_links long, groups string, block long, numbers binary, times binary, "
    "first int, pairs array<long>, links array<long>"
)


class _Block:
    """Documents whose pairs are numbered together."""

    def __init__(self, keys: pa.Schema, number: int):
        self.keys, self.number = keys, number
        self.kept: list[pa.RecordBatch] = []
        self.made: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.size = 0

    def add(self, kept: pa.RecordBatch, made: tuple[tuple, ...], pairs: tuple[np.ndarray, ...]) -> None:
        self.kept.append(kept)
        self.made += made
        self.pairs += pairs
        self.size += sum(map(len, pairs))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The documents, then the pairs of the block with how often it has them."""
        every, number = np.unique(np.concatenate(self.pairs), return_inverse=True)
        total = np.bincount(number, minlength=len(every))
        out, at = [], 0
        for made, pairs in zip(self.made, self.pairs, strict=True):
            mine, times = np.unique(number[at : at + len(pairs)], return_counts=True)
            at += len(pairs)
            out.append((*made, self.number, _planes(np.diff(mine, prepend=0)), _planes(times), None, None, None))
        made = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _MADE, strict=True)]
        at = 0
        for kept in self.kept:
            yield pa.record_batch([*kept.columns, *[c.slice(at, kept.num_rows) for c in made]], names=[*self.keys.names, *_MADE.names])
            at += kept.num_rows
        for first in range(0, len(every), _PAIRS_IN_ROW):
            some = slice(first, first + _PAIRS_IN_ROW)
            row = {"block": self.number, "first": first, "pairs": every[some].tolist(), "links": total[some].tolist()}
            blank = [pa.nulls(1, f.type) for f in self.keys]
            yield pa.record_batch([*blank, *[pa.array([row.get(f.name)], f.type) for f in _MADE]], names=[*self.keys.names, *_MADE.names])


def _rows(path_a: str, path_b: str, keys: list[str], groups: str, block_links: int):
    def row(parts: list[Part | None]) -> tuple[tuple, np.ndarray]:
        if not parts or None in parts:
            return (0, 0, 0, 0, ""), np.zeros(0, dtype=np.int64)
        in_a, in_b, pairs, texts = zip(*parts, strict=True)
        pairs = np.frombuffer(b"".join(pairs), dtype=np.int64)
        n_a, n_b = sum(in_a), sum(in_b)
        text = ";".join(texts)
        text = hashlib.sha256(text.encode()).hexdigest() if groups == "digest" else text
        return (n_a, n_b, n_a + n_b - len(pairs), len(pairs), text), pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Nothing here refers to itself, and looking through all remembered parts for cycles takes a fifth of the time.
        gc.disable()
        try:
            yield from aligned(batches)
        finally:
            gc.enable()

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b)
        number, block = TaskContext.get().partitionId() << _BLOCK_BITS, None
        for batch in batches:
            kept = batch.select(keys)
            texts = [t or b"" for t in batch.column("__text").cast(pa.large_binary()).to_pylist()]
            for i, j in packs(texts):
                made, pairs = zip(*map(row, align([align.parts(t.decode()) if t else [] for t in texts[i:j]])), strict=True)
                block = block or _Block(kept.schema, number)
                block.add(kept.slice(i, j - i), made, pairs)
                if block.size >= block_links or len(block.made) >= BLOCK_ROWS:
                    yield from block.rows()
                    block, number = None, number + 1
        if block is not None:
            yield from block.rows()

    return run


def _counted(kept: list[str]):
    """Documents of a block, with the counts of their links looked up in the block's counts."""

    def run(docs: pa.Table, counts: pa.Table) -> pa.Table:
        order = np.argsort(counts.column("number").to_numpy())
        count, best = (counts.column(c).to_numpy()[order] for c in ("count", "best"))
        sums, tops = [], []
        for numbers, times in zip(docs.column("numbers").to_pylist(), docs.column("times").to_pylist(), strict=True):
            mine, often = np.cumsum(_from_planes(numbers)), _from_planes(times)
            sums.append(int((count[mine] * often).sum()))
            tops.append(int(often[best[mine]].sum()))
        out = docs.select(kept)
        return out.append_column("n_best", pa.array(tops, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    return run


def align(
    docs: DataFrame,
    tokenizer_a: str,
    tokenizer_b: str,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    groups: str = "text",
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """One row per document: ``keep``, n_a, n_b, n_groups, n_links, groups, n_best, count_sum.

    ``tokenizer_a`` is the path of a byte-level tokenizer file and encodes a space and the text, ``tokenizer_b`` that of a
    sentencepiece model that adds the space itself; executors must be able to read both. Strings of special tokens in
    texts are plain text. Groups are cut where tokens of both end together; ``groups`` has their ids as
    ``a1,a2|b1;a3|b2,b3``, or with ``groups='digest'`` the SHA-256 of that in hex. Links are the overlapping pairs of
    tokens; the count of a pair of ids is how many links of all documents have it. ``n_best`` counts the links whose
    count is the highest of any with their B id, ``count_sum`` adds the counts of all links.

    A text that is null, empty, or not what the bytes of either tokenizer's tokens join to has no tokens: zeros and an
    empty text. Repeated rows get a row each and count each. No rows give no rows. Columns not in ``keep`` are ignored.

    At most a block's documents, pairs and counts meet in a task. What is sent to all tasks is a number for each B id.
    """
    keys = [f"__k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, keys, strict=True)], F.col(text).alias("__text"))
    fields = rows.drop("__text").schema.fields
    schema = T.StructType([*fields, *T.StructType.fromDDL(_MADE_DDL).fields])
    made = stored(rows.mapInArrow(_rows(tokenizer_a, tokenizer_b, keys, groups, block_links), schema), "tokens")

    pairs = made.where(F.col("first").isNotNull()).select("block", "first", F.posexplode(F.arrays_zip("pairs", "links")).alias("i", "p"))
    pairs = pairs.select("block", (F.col("first") + F.col("i")).alias("number"), F.col("p.pairs").alias("pair"), F.col("p.links").alias("links"))
    counts = stored(pairs.groupBy("pair").agg(F.sum("links").alias("count")), "pairs")
    low = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = counts.groupBy(low.alias("b")).agg(F.max("count").alias("highest"))
    # One row per B id: the vocabulary bounds it.
    counts = counts.withColumn("b", low).join(F.broadcast(highest), "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    found = pairs.drop("links").join(counts, "pair").select(F.col("block").alias("of"), "number", "count", "best")

    told = ["n_a", "n_b", "n_groups", "n_links", "groups"]
    texts = made.where(F.col("first").isNull()).select(*keys, *told, "block", "numbers", "times")
    out = T.StructType([f for f in schema if f.name in (*keys, *told)]).add("n_best", "long").add("count_sum", "long")
    done = texts.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(_counted([*keys, *told]), out)
    return done.select(*[F.col(k).alias(c) for c, k in zip(keep, keys, strict=True)], *told, "n_best", "count_sum")
