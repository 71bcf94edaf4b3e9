"""Packing of instruction data into sequences under several limits at once, by the dot-product heuristic.

An example is a vector: its tokens, one segment, and its tokens that bear loss. A sequence has a limit for each. One
sequence is filled at a time: of the examples that still fit, the one with the greatest dot product of its vector and
the room left goes in (each coordinate in parts of its limit, weighted by the demand for it), so that an example which
needs much of what the sequence has much of is preferred. When none fits whole, one is cut to fill the rest.

Sequences are built task by task from windows of examples. What is left of a window, less than a sequence, goes on into
the next one, so that a task holds one window however many rows it reads. A sequence that ends short of the limit on
tokens keeps as many as the greatest power of two and returns the others, so that cutting leaves no padding at all.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.llm.words import BLOCK, LOWER, mix, packs, range_hashes

#: Examples are packed in windows of about so many bytes of text, and of so many rows at most.
WINDOW_BYTES = 1 << 21
WINDOW_ROWS = 1 << 11
#: Words whose ids a task remembers, of at most so many bytes.
WORDS_KEPT = 1_000_000
LONG_WORD = 64
#: New words in one text to encode, and texts at a time.
WORDS_IN_TEXT = 100
TEXTS = 100

_SEQUENCE_BITS = 36  # sequence_id: task above, sequence of the task below


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss: int = 4096

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("limits must be positive")


class WordIds:
    """Ids of texts by a tokenizer that lower-cases and drops white space, word by word: equal words are encoded once.

    Texts are cut at spaces and line feeds, and where an ASCII letter meets another ASCII character: there the tokenizer
    ends a word too, whatever follows. A-Z are lower-cased first. Only a text that may hold a special token, which is
    looked for before all that, is cut at spaces and line feeds alone. Words are told apart on bytes, by their length
    and two 64-bit hashes; a string is made of new words only, and they are encoded side by side in longer texts, where
    the spans of their tokens part them. What is remembered of a word is where its ids stand in one array.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has a core, not the machine
        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content.encode()[:2] for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self._hashes, self._rows = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)  # sorted by hash
        self._checks, self._sizes = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        self._begin, self._n = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self._flat = np.empty(0, dtype="<u4")

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        pieces = [(i, piece) for i, t in enumerate(texts) for piece in _pieces(t.encode())]
        found: list[list[np.ndarray]] = [[] for _ in texts]
        for a, b in packs([piece for _, piece in pieces], WINDOW_BYTES):
            for (i, _), ids in zip(pieces[a:b], self._ids_of([piece for _, piece in pieces[a:b]]), strict=True):
                found[i].append(ids)
        return [f[0] if len(f) == 1 else np.concatenate(f) if f else np.empty(0, dtype="<u4") for f in found]

    def _ids_of(self, pieces: list[bytes]) -> list[np.ndarray]:
        line = b"\n".join(pieces)
        data = np.frombuffer(line, dtype=np.uint8)
        plain = not any(s in line for s in self._special)
        if plain:
            data = LOWER[data]
            line = data.tobytes()
        starts, ends, hashes, checks = _words(data, plain)
        sizes = ends - starts
        own, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        alike = first[which]
        if np.any(checks != checks[alike]) or np.any(sizes != sizes[alike]):  # two words of one hash: each for itself
            own, first, which = hashes, np.arange(len(starts)), np.arange(len(starts))
        at = np.searchsorted(self._hashes, own)
        row = self._rows[np.minimum(at, len(self._rows) - 1)] if len(self._rows) else np.zeros(len(own), dtype=np.int64)
        met = at < len(self._hashes)
        met[met] &= self._hashes[at[met]] == own[met]
        known = met.copy()
        known[met] &= (self._checks[row[met]] == checks[first[met]]) & (self._sizes[row[met]] == sizes[first[met]])
        new = np.flatnonzero(~known)
        ids, n_new = self._encoded([line[s:e].decode() for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
        begin, n = np.empty(len(own), dtype=np.int64), np.empty(len(own), dtype=np.int64)
        begin[known], n[known] = self._begin[row[known]], self._n[row[known]]
        begin[new], n[new] = len(self._flat) + np.cumsum(n_new) - n_new, n_new
        flat = np.concatenate((self._flat, ids))
        begin, n = begin[which], n[which]
        upto = np.append(0, np.cumsum(n))
        out = flat[np.repeat(begin - upto[:-1], n) + np.arange(upto[-1])]
        self._remember(new[~met[new] & (sizes[first[new]] <= LONG_WORD)], at, own, checks[first], sizes[first], new, n_new, flat)
        bounds = np.cumsum([0, *(len(p) + 1 for p in pieces)])
        edges = upto[np.searchsorted(starts, bounds)].tolist()
        return [out[i:j] for i, j in zip(edges, edges[1:])]

    def _remember(self, some: np.ndarray, at: np.ndarray, own: np.ndarray, checks: np.ndarray, sizes: np.ndarray, new: np.ndarray, n_new: np.ndarray, flat: np.ndarray) -> None:
        if len(self._hashes) + len(some) > WORDS_KEPT:
            return self._forget()
        some = some[np.append(True, own[some][1:] != own[some][:-1])] if len(some) else some
        begin = np.zeros(len(own), dtype=np.int64)
        begin[new] = len(self._flat) + np.cumsum(n_new) - n_new
        n = np.zeros(len(own), dtype=np.int64)
        n[new] = n_new
        rows = np.arange(len(some)) + len(self._checks)
        order = np.argsort(own[some], kind="stable")
        self._hashes = np.insert(self._hashes, at[some][order], own[some][order])
        self._rows = np.insert(self._rows, at[some][order], rows[order])
        self._checks, self._sizes = np.concatenate((self._checks, checks[some])), np.concatenate((self._sizes, sizes[some]))
        self._begin, self._n = np.concatenate((self._begin, begin[some])), np.concatenate((self._n, n[some]))
        self._flat = flat

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        ids, counts = [np.empty(0, dtype="<u4")], [np.empty(0, dtype=np.int64)]
        lines = [words[i : i + WORDS_IN_TEXT] for i in range(0, len(words), WORDS_IN_TEXT)]
        for first in range(0, len(lines), TEXTS):
            some = lines[first : first + TEXTS]
            for line, e in zip(some, self._tokenizer.encode_batch([" ".join(x) for x in some], add_special_tokens=False), strict=True):
                ids.append(np.array(e.ids, dtype="<u4"))
                last = np.array([end for _, end in e.offsets], dtype=np.int64)
                stops = np.searchsorted(last, np.cumsum([len(w) + 1 for w in line]) - 1, side="right")
                counts.append(np.diff(stops, prepend=0))
        return np.concatenate(ids), np.concatenate(counts)


_BREAK = re.compile(rb"[ \n]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about BLOCK bytes that end between words."""
    at = 0
    while len(text) - at > BLOCK and (m := _BREAK.search(text, at + BLOCK)):
        yield text[at : m.start()]
        at = m.end()
    yield text[at:] if at else text


def _words(data: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between spaces and line feeds, and two hashes of each. ``plain`` lower-cased texts are cut
    behind ASCII letters too, unless a letter or a byte of another character follows."""
    inside = (data != 32) & (data != 10)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if plain:
        letter = (data >= 97) & (data <= 122)
        begins[1:] |= letter[:-1] & inside[1:] & ~letter[1:] & (data[1:] < 128)
    starts = np.flatnonzero(begins)
    stops = np.append(np.flatnonzero(begins | ~inside), len(data))
    ends = stops[np.searchsorted(stops, starts, side="right")]
    values = data.astype(np.uint64) + np.uint64(1)
    return starts, ends, range_hashes(values, starts, ends), range_hashes(_SCATTERED[data], starts, ends)


_SCATTERED = mix(np.arange(1, 257, dtype=np.uint64))


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


class Example:
    """Ids of an example and, where not all of them do, which bear loss."""

    __slots__ = ("ids", "bears", "before")

    def __init__(self, ids: np.ndarray, bears: np.ndarray | None):
        self.ids, self.bears = ids, bears
        self.before = None if bears is None else np.concatenate(([0], np.cumsum(bears)))

    def loss(self, start: int, end: int) -> int:
        return end - start if self.before is None else int(self.before[end] - self.before[start])

    def within(self, start: int, end: int, tokens: int, loss: int) -> int:
        """The end of the longest piece from ``start`` of so many tokens and loss-bearing tokens at most."""
        end = min(end, start + tokens)
        if self.before is None:
            return min(end, start + loss)
        return min(end, int(np.searchsorted(self.before, self.before[start] + loss, side="right")) - 1)


Piece = tuple[int, int, int]  # example, start, end


def sequences(examples: list[Example], pool: list[Piece], limits: Limits, cut: bool, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences from the pieces of ``pool``, and the pieces left. All are used up if ``last``; else whole sequences'
    worth. Without ``cut`` a piece is divided only if it exceeds the limits by itself."""
    if not cut:
        pool = [part for piece in pool for part in _divided(examples, piece, limits)]
    size = len(pool) + 1
    which, start, end, tokens, loss = (np.zeros(size, dtype=np.int64) for _ in range(5))
    alive = np.zeros(size, dtype=bool)
    free = list(range(size - 1, -1, -1))
    left = 0

    def put(piece: Piece) -> int:
        nonlocal left
        i = free.pop()
        which[i], start[i], end[i] = piece
        tokens[i], loss[i], alive[i] = piece[2] - piece[1], examples[piece[0]].loss(piece[1], piece[2]), True
        left += tokens[i]
        return i

    def take(i: int, stop: int | None = None) -> Piece:
        nonlocal left
        piece = (int(which[i]), int(start[i]), int(end[i]) if stop is None else stop)
        alive[i] = False
        free.append(i)
        left -= tokens[i]
        if stop is not None and stop < end[i]:
            put((piece[0], stop, int(end[i])))
        return piece

    for piece in pool:
        put(piece)
    def put_back(piece: Piece) -> None:
        """Of each example one piece is left, its end: what comes back is joined to the rest."""
        for i in np.flatnonzero(alive & (which == piece[0]) & (start == piece[2])):
            piece = (piece[0], piece[1], take(int(i))[2])
        put(piece)

    bounds = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
    pieces = max(1, int(alive.sum()))
    demand = np.array([tokens[alive].sum(), pieces, loss[alive].sum()]) / bounds / pieces
    weight = demand / bounds / bounds  # both vectors are in parts of the limits
    done: list[list[Piece]] = []
    while left and (last or left >= limits.tokens):
        room = np.array([limits.tokens, limits.segments, limits.loss])
        chosen: list[Piece] = []
        while room[0] and room[1] and alive.any():
            value = tokens * (weight[0] * room[0]) + loss * (weight[2] * room[2])  # one segment each: no difference
            fits = alive & (tokens <= room[0]) & (loss <= room[2])
            if fits.any():
                piece = take(int(np.argmax(np.where(fits, value, -1))))
            elif cut and (fitting := _cuttable(examples, which, start, alive, room[2])).any():
                i = int(np.argmax(np.where(fitting, value, -1)))
                piece = take(i, examples[which[i]].within(int(start[i]), int(end[i]), int(room[0]), int(room[2])))
            else:
                break
            chosen.append(piece)
            room -= (piece[2] - piece[1], 1, examples[piece[0]].loss(piece[1], piece[2]))
        held = int(limits.tokens - room[0])
        if cut and room[0]:
            for piece in _shortened(chosen, held - (1 << held.bit_length() - 1)):
                put_back(piece)
        done.append(chosen)
    return done, [(int(which[i]), int(start[i]), int(end[i])) for i in np.flatnonzero(alive)]


def _divided(examples: list[Example], piece: Piece, limits: Limits) -> Iterator[Piece]:
    """A piece in as few parts as the limits allow."""
    which, start, end = piece
    while start < end:
        stop = examples[which].within(start, end, limits.tokens, limits.loss)
        yield which, start, stop
        start = stop


def _cuttable(examples: list[Example], which: np.ndarray, start: np.ndarray, alive: np.ndarray, loss: int) -> np.ndarray:
    """Pieces of which at least one token has room: any if loss has room, else those that begin with one without loss."""
    if loss:
        return alive
    out = alive.copy()
    for i in np.flatnonzero(alive):
        e = examples[which[i]]
        out[i] = e.bears is not None and not e.bears[start[i]]
    return out


def _shortened(chosen: list[Piece], surplus: int) -> list[Piece]:
    """Takes ``surplus`` tokens off the end of a sequence and returns them as pieces."""
    back = []
    while surplus:
        which, start, end = chosen.pop()
        off = min(surplus, end - start)
        if off < end - start:
            chosen.append((which, start, end - off))
        back.append((which, end - off, end))
        surplus -= off
    return back


def _examples(batch: pa.RecordBatch, ids: WordIds, end_id: int) -> Iterator[Example]:
    rows = [[(s["text"] or "", bool(s["loss"])) for s in r if s is not None] if r is not None else [] for r in batch.column("segments").to_pylist()]
    coded = iter(ids([text for r in rows for text, _ in r]))
    stop = np.array([end_id], dtype="<u4")
    for r in rows:
        parts = [(next(coded), loss) for _, loss in r]
        parts.append((stop, parts[-1][1] if parts else True))
        bears = None
        if not all(loss for _, loss in parts):
            bears = np.concatenate([np.full(len(p), loss) for p, loss in parts])
        yield Example(np.concatenate([p for p, _ in parts]), bears)


def _runs(bears: np.ndarray | None, n: int) -> list[int]:
    if bears is None:
        return [0, n]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], bears, [False])).astype(np.int8)))
    return edges.tolist()


_MADE = pa.schema(
    [
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("loss_runs", pa.list_(pa.int32())),
        ("n_loss", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def _rows(examples: list[Example], kept: dict[str, pa.Array], found: list[list[Piece]], first: int) -> pa.RecordBatch:
    """The pieces of sequences numbered from ``first``."""
    out: list[tuple] = []
    for n, sequence in enumerate(found, first):
        offset = 0
        for which, start, end in sequence:
            e = examples[which]
            runs = _runs(None if e.bears is None else e.bears[start:end], end - start)
            out.append((start, end - start, e.ids[start:end].tobytes(), runs, e.loss(start, end), len(e.ids), n, offset))
            offset += end - start
    made = [pa.array(column, f.type) for column, f in zip(zip(*out, strict=True), _MADE, strict=True)]
    at = pa.array([p[0] for sequence in found for p in sequence], pa.int64())
    return pa.record_batch([*(column.take(at) for column in kept.values()), *made], names=[*kept, *_MADE.names])


def _packer(path: str, keys: list[str], limits: Limits, cut: bool, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Nothing here refers to itself; looking through all remembered words for cycles would take its time.
        gc.disable()
        try:
            yield from packed(batches)
        finally:
            gc.enable()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, number = word_ids(path), TaskContext.get().partitionId() << _SEQUENCE_BITS
        examples: list[Example] = []
        kept: dict[str, pa.Array] = {}
        pool: list[Piece] = []

        def pack(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, examples, kept, pool
            found, pool = sequences(examples, pool, limits, cut, last)
            if found:
                yield _rows(examples, kept, found, number)
                number += len(found)
            # Only examples that are not used up go on.
            held = sorted({p[0] for p in pool})
            to = {old: new for new, old in enumerate(held)}
            examples = [examples[i] for i in held]
            kept = {k: column.take(pa.array(held, pa.int64())) for k, column in kept.items()}
            pool = [(to[i], a, b) for i, a, b in pool]

        for batch in batches:
            for part in _windows(batch):
                new = list(_examples(part, ids, end_id))
                kept = {k: pa.concat_arrays([kept[k], part.column(k)]) if k in kept else part.column(k) for k in keys}
                pool += [(i, 0, len(e.ids)) for i, e in enumerate(new, len(examples))]
                examples += new
                yield from pack(False)
        yield from pack(True)

    return run


def _windows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of about WINDOW_BYTES and of WINDOW_ROWS at most at a time: Arrow batches count rows, not bytes."""
    step = max(1, min(WINDOW_ROWS, int(batch.num_rows * WINDOW_BYTES / max(1, batch.nbytes))))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def pack(
    examples: DataFrame,
    tokenizer: str,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    segments: str = "segments",
    limits: Limits = Limits(),
    cut: bool = True,
    end_id: int = 2,
) -> DataFrame:
    """One row per piece: ``keep``, start, length, ids, loss_runs, n_loss, doc_tokens, sequence_id, offset.

    ``segments`` is an array of (text, loss): the turns of an example, and whether their tokens bear loss. An example's
    tokens are the ids of its texts one after another and ``end_id``, which bears loss if the last turn does.
    ``tokenizer`` is the path of a tokenizer file that executors can read. ``ids`` are little-endian 32-bit numbers,
    ``loss_runs`` the places in the piece where runs of loss-bearing tokens start and end. A sequence has at most
    ``limits.tokens`` tokens, ``limits.segments`` pieces and ``limits.loss`` loss-bearing tokens; offsets of its pieces
    are gapless. With ``cut`` pieces divide examples freely, and every sequence has ``limits.tokens`` tokens or a power of
    two of them. Without, only examples beyond a limit are divided, and sequences may be short.

    Null texts and turns are empty, an example without turns is its end id, which then bears loss. Repeated rows and
    ids are packed each for itself. No rows give no rows. Columns not in ``keep`` are ignored; keep no column named as
    one of the result. Nothing is shuffled: a task packs the rows it reads, in the order in which it reads them, so
    that a task that is run again gives the same rows.
    """
    keys = list(keep)
    rows = examples.select(*keys, F.col(segments).alias("segments"))
    made = "start long, length long, ids binary, loss_runs array<int>, n_loss long, doc_tokens long, sequence_id long, offset long"
    schema = T.StructType([*rows.drop("segments").schema.fields, *T.StructType.fromDDL(made).fields])
    return rows.mapInArrow(_packer(tokenizer, keys, limits, cut, end_id), schema)
