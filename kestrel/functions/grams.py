"""Fingerprints of short byte runs (grams) of texts, in numpy over Arrow columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK = 1 << 17         # text bytes handled at once (their arrays stay in cache), or one longer text
MARKS = 1 << 24          # bits of the bitmap of wanted fingerprints (2 MB)
_BASE = 0x9E3779B97F4A7C15 | 1


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_BYTE = _scrambled(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


_POWERS = {base: np.ones(1, np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64))}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; those of a block's length stay."""
    if len(_POWERS[base]) >= n:
        return _POWERS[base][:n]
    x = np.full(n, base, np.uint64)
    x[0] = 1
    x = np.multiply.accumulate(x)
    if n <= _BLOCK + 1:
        _POWERS[base] = x
    return x


def _running(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the bytes' values by place, and the powers that undo the place."""
    up, down = _powers(_BASE, len(buf) + 1), _powers(pow(_BASE, -1, 1 << 64), len(buf) + 1)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * up[:-1]))), down


def _least(total: np.ndarray, down: np.ndarray, size: int, window: int) -> np.ndarray:
    """At every place the least fingerprint of the ``window`` grams from there on."""
    n = len(total) - 1 - (size + window - 1) + 1
    key = _scrambled((total[size:] - total[:-size]) * down[:len(total) - size])
    least, width = key, 1                        # minima of 1, 2, 4, ... grams, then of two that overlap
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[:n], least[window - width:][:n])


def _distinct(row: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    for order in (False, True):                  # neighbours first, so that few are sorted
        if order:
            place = np.lexsort((gram, row))
            row, gram = row[place], gram[place]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        row, gram = row[first], gram[first]
    return row, gram


def window_minima(buf: np.ndarray, offset: np.ndarray, size: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, fingerprint): the least fingerprint of every ``window``
    neighbouring grams of ``size`` bytes of a row (winnowing).  Texts that share
    ``size + window - 1`` bytes share the window, so they share its minimum."""
    span = size + window - 1
    n = len(buf) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _least(*_running(buf), size, window)
    row = np.repeat(np.arange(len(offset) - 1), np.diff(offset))
    ok = np.flatnonzero(np.arange(n) + span <= offset[1:][row[:n]])
    return _distinct(row[ok], least[ok])


def marked_minima(buf: np.ndarray, offset: np.ndarray, tiers: list[tuple[int, int, int]],
                  marks: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(tier, rows, fingerprints): what ``window_minima`` gives for each tier (number,
    size, window), of fingerprints with a mark only.  The bytes are gone through once;
    only marked places are ordered."""
    total, down = _running(buf)
    for tier, size, window in tiers:
        span = size + window - 1
        if len(buf) < span:
            continue
        least = _least(total, down, size, window)
        bit = least & np.uint64(MARKS - 1)
        at = np.flatnonzero((marks[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)
        row = np.searchsorted(offset, at, "right") - 1
        ok = at + span <= offset[row + 1]
        yield tier, *_distinct(row[ok], least[at[ok]])


def _blocks(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of the texts of a batch, in blocks."""
    text = b.column(1).fill_null("").cast(pa.large_string())
    _, off, data = text.buffers()
    offset = np.frombuffer(off, np.int64)[text.offset:text.offset + len(text) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(offset, offset[lo] + _BLOCK, "right")) - 1)
        yield lo, raw[offset[lo]:offset[hi]], offset[lo:hi + 1] - offset[lo]
        lo = hi


def _texts(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src, src.schema["id"].dataType.simpleString()


def gram_rows(df: DataFrame, id_col: str, text_col: str, size: int, window: int) -> DataFrame:
    """(``id``, ``gram``): the window minima of every text, each once per row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, buf, offset in _blocks(b):
                row, gram = window_minima(buf, offset, size, window)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row + lo)), pa.array(gram.view(np.int64))],
                                                 ["id", "gram"])

    src, kind = _texts(df, id_col, text_col)
    return src.mapInArrow(run, f"id {kind}, gram long")


def gram_marks(grams: DataFrame, gram: str = "gram") -> np.ndarray:
    """A bitmap of ``MARKS`` bits with one set for every fingerprint of the column, by
    its last bits; it is put together in tasks, so its fixed size is all that is fetched."""
    place = F.col(gram).bitwiseAND(F.lit(MARKS - 1)) + 1
    parts = (grams.select(place.alias("__p")).groupBy(F.bitmap_bucket_number("__p").alias("k"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__p")).alias("bits")).collect())
    marks = np.zeros(MARKS // 8, np.uint8)
    for k, bits in parts:
        marks[(k - 1) * 4096:k * 4096] = np.frombuffer(bits, np.uint8)
    return marks


def marked_gram_rows(df: DataFrame, id_col: str, text_col: str, tiers: list[tuple[int, int, int]],
                     marks: np.ndarray) -> DataFrame:
    """(``id``, ``tier``, ``gram``): the window minima of every text for all ``tiers``
    (number, size, window) in one pass, those with a mark only; a few others share one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, buf, offset in _blocks(b):
                found = list(marked_minima(buf, offset, tiers, marks))
                if found:
                    tier, row, gram = (np.concatenate(x) for x in zip(*((np.full(len(r), t, np.int32), r + lo, g) for t, r, g in found)))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(tier), pa.array(gram.view(np.int64))],
                                                     ["id", "tier", "gram"])

    src, kind = _texts(df, id_col, text_col)
    return src.mapInArrow(run, f"id {kind}, tier int, gram long")
