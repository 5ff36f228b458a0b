"""Words, word hashes and shingles of Arrow text batches, in numpy.

A word is a maximal run of bytes other than the ASCII white space
``\\x20\\x09-\\x0D``.  Those bytes never occur inside a multi-byte UTF-8
character, so cutting the bytes cuts the characters in the same places.
Everything here is a helper inside Spark tasks: memory is a small multiple of
``CHUNK`` bytes, or of the longest single text where that is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20          # text bytes handled at once
_BLOCK = 1 << 19         # bytes hashed at once
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (two multiply-xorshift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class _Powers:
    """Powers of the odd base and of its inverse modulo 2**64, grown on need."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            for name, base in (("up", _BASE), ("down", inverse)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the odd base and of its inverse."""
    return _POWERS.get(n)


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span (spans ordered, not overlapping)."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + _BLOCK, "right")))
        hi = int(ends[j - 1])
        up, down = _POWERS.get(max(hi - lo, min(_BLOCK, len(buf))) + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[buf[lo:hi]] * up[:hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


@dataclass
class Words:
    """The words of some rows: ``buf`` holds their texts, word ``i`` is
    ``buf[start[i]:end[i]]`` and belongs to local row ``row[i]``; row ``r`` has
    words ``first[r]:first[r + 1]`` and bytes ``offset[r]:offset[r + 1]``."""

    buf: np.ndarray
    offset: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        return hash_spans(LOWER[self.buf] if lower else self.buf, self.start, self.end)

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offset = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offset[0]:offset[-1]], offset - offset[0]


def split_words(buf: np.ndarray, offset: np.ndarray, separator: np.ndarray = SEPARATOR) -> Words:
    gap = separator[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offset] = True
    before = np.concatenate(([True], gap[:-1])) | edge[:-1] if len(buf) else np.zeros(0, bool)
    after = np.concatenate((gap[1:], [True])) | edge[1:] if len(buf) else np.zeros(0, bool)
    start = np.flatnonzero(~gap & before)
    end = np.flatnonzero(~gap & after) + 1
    first = np.searchsorted(start, offset)
    row = np.repeat(np.arange(len(offset) - 1), np.diff(first))
    return Words(buf, offset, start, end, row, first)


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets): consecutive rows of about
    ``size`` bytes of text, a longer single text alone."""
    buf, offset = text_bytes(column)
    lo, n = 0, len(offset) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offset, offset[lo] + size, "right")) - 1)
        yield lo, hi, buf[offset[lo]:offset[hi]], offset[lo:hi + 1] - offset[lo]
        lo = hi


def shingle_hashes(words: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words of one row, and the run's first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j:j + n] * np.uint64(pow(int(_BASE), j, 1 << 64))
    ok = np.flatnonzero(words.row[:n] == words.row[k - 1:])
    return mix(out[ok]), ok


def window_hashes(words: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``shingle_hashes`` by prefix sums, for long runs."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _POWERS.get(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:len(h)], out=total[1:])
    ok = np.flatnonzero(words.row[:n] == words.row[k - 1:])
    return mix((total[ok + k] - total[ok]) * down[ok]), ok


def distinct_per_row(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, value) pairs ordered by row, then value."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    if len(row):
        keep = np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])))
        row, value = row[keep], value[keep]
    return row, value


def document_sets(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's distinct ``k``-word shingles over ASCII
    lower-cased words; with fewer words the whole sequence is the one shingle;
    rows without words have none."""
    h = words.hashes(lower=True)
    value, at = shingle_hashes(words, h, k)
    row = words.row[at]
    few = np.flatnonzero((words.count > 0) & (words.count < k))
    if len(few):
        short = np.empty(len(few), np.uint64)
        for i, r in enumerate(few):
            x = np.full(1, words.count[r], np.uint64)
            for w in range(words.first[r], words.first[r + 1]):
                x = mix(x * _BASE + h[w:w + 1])
            short[i] = x[0]
        row, value = np.concatenate((row, few)), np.concatenate((value, short))
    return distinct_per_row(row, value)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
