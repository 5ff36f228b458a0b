"""Operator 7: quality rules and line sequence labelling.

Base rules count words, symbols, repeated lines and repeated three-word runs of
the whole text.  Then a linear-chain conditional random field reads a document
as a sequence of lines and marks each as content or boilerplate by Viterbi; the
share of words in content lines decides.  Features are shapes, not words, so
they hold for any language.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .crf import Chain, train
from .line_labels import DOCUMENTS
from .tables import bounded_batches, emit, group_starts, source, tidy
from .words import Words, chunks, hash_spans, shingle_hashes, split_words, text_bytes

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LOUD = _SYMBOL.copy()
_LOUD[[ord(c) for c in "!=~^_"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".?!:;,"]] = True

TAGS = ["content", "boilerplate"]
SHARES = [0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75]
SIZES = [6, 8, 8, 8, 8, 8, 8, 2, 2, 6]


def _sum(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[end] - total[start]


class Lines:
    """The lines with a word of some rows, and their features."""

    def __init__(self, w: Words, h: np.ndarray) -> None:
        buf = w.buf
        edge = np.zeros(len(buf) + 1, bool)
        edge[w.offset] = True
        edge[np.flatnonzero(buf == 10) + 1] = True
        start = np.flatnonzero(edge[:-1]) if len(buf) else np.zeros(0, np.int64)
        end = np.append(start[1:], len(buf)) if len(start) else start
        # a line ends before its \n
        end = end - (buf[end - 1] == 10) if len(start) else end
        first = np.searchsorted(w.start, start)
        last = np.searchsorted(w.start, end)
        has = last > first
        self.start, self.end = start[has], end[has]
        self.first, self.last = first[has], last[has]
        self.row = w.row[self.first] if has.any() else np.zeros(0, np.int64)
        self.bound = np.searchsorted(self.row, np.arange(len(w.offset)))
        n = len(self.start)
        key = hash_spans(buf, self.start, self.end)
        order = np.lexsort((np.arange(n), key, self.row))
        self.repeat = np.ones(n, bool)
        self.repeat[order] = ~group_starts(self.row[order], key[order])
        self.words = self.last - self.first
        self._w, self._h = w, h

    def features(self) -> list[np.ndarray]:
        w, h, buf = self._w, self._h, self._w.buf
        words = np.maximum(self.words, 1)
        chars = np.maximum(_sum(np.ones(len(buf), bool), w.start[self.first], w.end[self.last - 1]), 1)

        def share(x: np.ndarray, of: np.ndarray) -> np.ndarray:
            return np.searchsorted(SHARES, x / np.maximum(of, 1), "right")

        def chars_of(mask: np.ndarray) -> np.ndarray:
            return _sum(mask[buf], self.start, self.end)

        again = np.zeros(len(h), bool)
        again[1:] = h[1:] == h[:-1]
        loud_end = _LOUD[buf[w.end - 1]]
        bar = (w.end - w.start == 1) & _LOUD[buf[w.start]]
        letters = chars_of(_LETTER)
        return [np.searchsorted([3, 6, 12, 25, 60], self.words, "right"),
                share(chars_of(_LOUD), chars), share(chars_of(_UPPER), letters),
                share(chars_of(_DIGIT), chars), share(_sum(again, self.first, self.last), words),
                share(_sum(loud_end, self.first, self.last), words), share(_sum(bar, self.first, self.last), words),
                _STOP[buf[w.end[self.last - 1] - 1]].astype(np.int64), self.repeat.astype(np.int64),
                np.searchsorted([2.5, 4, 5.5, 8, 12], (self.end - self.start) / words, "right")]


def line_model() -> Chain:
    """The chain fitted to the labelled lines."""
    texts = ["\n".join(x for _, x in d) for d in DOCUMENTS]
    w = split_words(*text_bytes(pa.array(texts)))
    lines = Lines(w, w.hashes())
    gold = np.array([int(t == "B") for d in DOCUMENTS for t, _ in d])
    return train(lines.features(), SIZES, lines.bound, gold, TAGS)


def _repeated_words(w: Words, h: np.ndarray, k: int = 3) -> np.ndarray:
    """Mask of the words in a run of ``k`` that its row has twice or more."""
    value, at = shingle_hashes(w, h, k)
    row = w.row[at]
    order = np.lexsort((value, row))
    head = group_starts(row[order], value[order])
    size = np.diff(np.append(np.flatnonzero(head), len(order)))
    many = at[order[np.repeat(size, size) > 1]]
    mark = np.zeros(len(h), bool)
    for j in range(k):
        mark[many + j] = True
    return mark


_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, content_share double, kept boolean")
_NAMES = [x.split()[0] for x in _SCHEMA.split(", ")]


def _measures(column: pa.Array, model: Chain) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for lo, hi, buf, offset in chunks(column):
        w = split_words(buf, offset)
        h = w.hashes()
        lines = Lines(w, h)
        a, z = w.first[:-1], w.first[1:]
        n = w.count
        points = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
        chars = np.concatenate(([0], np.cumsum(points[w.end] - points[w.start])))
        symbols = _sum(_SYMBOL[buf], offset[:-1], offset[1:])
        dup = np.bincount(lines.row[lines.repeat], minlength=hi - lo)
        again = _sum(_repeated_words(w, h), a, z)
        tag = model.decode(lines.features(), lines.bound) if len(lines.row) else np.zeros(0, np.uint8)
        good = np.bincount(lines.row, weights=np.where(tag == 0, lines.words, 0), minlength=hi - lo)
        share = good / np.maximum(n, 1)
        failed = (n < MIN_WORDS) | (100 * again > MAX_REPEAT_PERCENT * n)
        yield lo, hi, [n, chars[z] - chars[a], symbols, dup, again, failed, share,
                       ~failed & (share >= MIN_CONTENT)]


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``base_failed``, ``content_share``
    (share of the words that stand in content lines) and ``kept``.

    Null and empty texts have no words and fail.  Repeated rows come out as
    often as they went in, a null id stays null, an empty table gives no rows;
    other columns are not looked at."""
    model = line_model()

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, cols in _measures(b.column(1), model):
                yield from emit(["doc_id", *_NAMES], [b.column(0).slice(lo, hi - lo), *cols])

    src = source(docs, id_col, text_col)
    return src.mapInArrow(run, f"doc_id long, {_SCHEMA}")


def keep_content(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the rules or the line model reject, in one
    pass without a shuffle."""
    bounded_batches(docs.sparkSession)
    model, names = line_model(), docs.columns

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for lo, hi, cols in _measures(b.column(at), model):
                keep[lo:hi] = cols[-1]
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
