"""Words of whole texts as arrays of hashes, computed on bytes without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text handled at a time: eight-byte arrays of that length are what a task holds besides its batch.
BLOCK = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word characters after A-Z are lower-cased: digits, a-z and every byte of a character above U+007F.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(BLOCK + (1 << 16), n + 1)
    if size not in _powers:
        _powers.clear()
        tables = []
        for base in (_BASE, _INVERSE):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            tables.append(np.multiply.accumulate(row))
        _powers[size] = (tables[0], tables[1])
    up, down = _powers[size]
    return up, down


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range of 64-bit values, by value and place in the range."""
    up, down = _power_tables(len(values))
    total = np.empty(len(values) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _block(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = WORD[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate(([0], edges))
    if inside[-1]:
        edges = np.concatenate((edges, [len(data)]))
    starts, ends = edges[0::2], edges[1::2]
    return starts, ends, range_hashes(data.astype(np.uint64) + np.uint64(1), starts, ends)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of lower-cased bytes, block by block, cut where no word is."""
    at, found = 0, []
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data) and WORD[data[end]] and WORD[data[end - 1]]:
            step = np.flatnonzero(~WORD[data[end : end + BLOCK]])
            end = end + int(step[0]) if len(step) else min(len(data), end + BLOCK)
        starts, ends, hashes = _block(data[at:end])
        found.append((starts + at, ends + at, hashes))
        at = end
    if not found:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, np.empty(0, dtype=np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions have none."""
    size = len(words) - n + 1
    if size <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(size, dtype=np.uint64)
    for j in range(n):
        out += words[j : j + size] * np.uint64((2 * j + 1) * 0xD6E8FEB86659FD93 % (1 << 64) | 1)
    return mix(out + np.uint64(n))


def packs(texts: list[bytes], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together; a longer text is a range of its own."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if i > first and held + len(t) > limit:
            yield first, i
            first, held = i, 0
        held += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one lower-cased array with a byte that is no word between them, and where each begins."""
    data = LOWER[np.frombuffer(b"\0".join(texts), dtype=np.uint8)]
    begin = np.zeros(len(texts), dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=begin[1:])
    return data, begin
