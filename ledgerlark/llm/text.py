"""Words and word shingles of Arrow text columns as 64-bit hashes, without a Python object per word.

A word is a maximal run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Hashes are taken
from running polynomial sums, so the cost is a few array passes over the bytes. Long texts are read in
segments cut between words: working memory depends on the segment, never on the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACED = np.ones(256, dtype=bool)
SPACED[[32, *range(9, 14)]] = False
#: Letters and digits of ASCII and every byte of longer characters: words without punctuation.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

_powers = {"base": np.ones(1, dtype=np.uint64), "inverse": np.ones(1, dtype=np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    if len(_powers["base"]) < n:
        size = max(n, SEGMENT)
        for name, factor in (("base", BASE), ("inverse", BASE_INVERSE)):
            table = np.full(size, factor, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["base"][:n], _powers["inverse"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit value."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): row i is bytes[bounds[i]:bounds[i + 1]]; a null is an empty row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), bounds


def segments(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray, size: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Spans of about ``size`` bytes that end at a row's end or, in a longer row, before a space."""
    at, end = int(bounds[0]), int(bounds[-1])
    while at < end:
        stop = int(bounds[np.searchsorted(bounds, min(at + size, end), side="right") - 1])
        if stop <= at:
            stop, row_end = at + size, int(bounds[np.searchsorted(bounds, at, side="right")])
            while stop < row_end:
                breaks = np.flatnonzero(~is_word[LOWER[data[stop : min(stop + size, row_end)]]])
                if len(breaks):
                    stop += int(breaks[0])
                    break
                stop += size
            stop = min(stop, row_end)
        yield at, stop
        at = stop


def word_hashes(column: pa.Array, is_word: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the words of row i, in order, are hashes[bounds[i]:bounds[i + 1]]."""
    data, rows = text_bytes(column)
    hashes, starts = [], []
    for first, last in segments(data, rows, is_word):
        part = LOWER[data[first:last]]
        word = is_word[part]
        cuts = rows[np.searchsorted(rows, first, side="right") : np.searchsorted(rows, last)] - first
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1]
        closes[:-1] &= ~word[1:]
        cuts = cuts[(cuts > 0) & (cuts < len(part))]
        opens[cuts] = word[cuts]
        closes[cuts - 1] = word[cuts - 1]
        opens, closes = np.flatnonzero(opens), np.flatnonzero(closes)
        up, down = powers(len(part))
        total = np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up)
        before = np.where(opens > 0, total[opens - 1], np.uint64(0))
        hashes.append(mixed((total[closes] - before) * down[opens] + (closes - opens).astype(np.uint64)))
        starts.append(opens + first)
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(rows), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), rows)


def factors(k: int) -> np.ndarray:
    return mixed(np.arange(1, k + 1, dtype=np.uint64) * BASE) | np.uint64(1)


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of the k-word shingles of one text, in order; of the whole text if it is shorter."""
    n = len(words)
    if not n:
        return words
    weights = factors(k)
    if n < k:
        return mixed((words * weights[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    joined = words[: n - k + 1] * weights[0]
    for j in range(1, k):
        joined += words[j : n - k + 1 + j] * weights[j]
    return mixed(joined)


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    if len(values) < 2:
        return values
    first = np.empty(len(values), dtype=bool)
    first[0] = True
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its shingles."""
    words, bounds = word_hashes(column)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        yield distinct(shingles(words[a:b], k))


class Minima:
    """Minima of one text's hashes under many random functions a * x + b modulo 2**32."""

    def __init__(self, functions: int, seed: int = 7, block: int = 256):
        random = np.random.default_rng(seed)
        self.a = random.integers(0, 1 << 31, (functions, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = random.integers(0, 1 << 32, (functions, 1), dtype=np.uint32)
        self.block = block
        self.room = np.empty((functions, block), dtype=np.uint32)

    def narrowed(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(32)).astype(np.uint32)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        x = self.narrowed(hashes)
        least = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(x), self.block):
            part = x[at : at + self.block]
            room = self.room[:, : len(part)]
            np.multiply(self.a, part, out=room)
            np.add(room, self.b, out=room)
            np.minimum(least, room.min(axis=1), out=least)
        return least
