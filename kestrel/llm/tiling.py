"""Operator 9: benchmark decontamination by greedy string tiling.

Words are compared in lower case without ASCII punctuation.  The benchmark is
the stated query set: it goes through in blocks of bounded size, each block
broadcast to one pass over all documents.  A document joins an item where they
share a seed, a run of ``k`` words with equal running (Karp-Rabin) hashes.  For
each such pair the longest common run of unmarked words is marked in both, again
and again, until none of ``k`` words is left.  The marked share of the item's
words is its coverage; order doesn't matter, so reordered passages count.  The
runs come from the hits of seeds or, where words repeat so that a pair has very
many, from running hashes of halved lengths; the tiles are the same.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, source, tidy
from .words import SEPARATOR, Words, chunks, powers, shingle_hashes, split_words

SEED = 5
COVERAGE = 0.5
BLOCK_BYTES = 8 << 20
_HITS = 1 << 14          # pairs of equal seeds that a document and an item may list

_BREAK = SEPARATOR.copy()
for _c in range(128):
    if not chr(_c).isalnum():
        _BREAK[_c] = True


def _words(buf: np.ndarray, offset: np.ndarray) -> Words:
    return split_words(buf, offset, _BREAK)


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.fill_null(""))


@dataclass
class Block:
    """Items of a block: ids, word hashes, and their seeds in hash order."""

    ids: list[int | None]
    words: list[np.ndarray]
    seed: np.ndarray      # sorted hashes
    item: np.ndarray
    place: np.ndarray
    group: np.ndarray     # where the entries of each (seed, item) begin
    sieve: np.ndarray     # which low bits any seed has

    @classmethod
    def of(cls, ids: list, texts: list[str], k: int) -> Block:
        column = _lower(pa.array(texts, pa.string()))
        hashes: list[np.ndarray] = []
        seed, item, place = [], [], []
        for lo, hi, buf, offset in chunks(column):
            w = _words(buf, offset)
            h = w.hashes()
            value, at = shingle_hashes(w, h, k)
            hashes += [h[w.first[r]:w.first[r + 1]] for r in range(hi - lo)]
            seed.append(value)
            item.append(w.row[at] + lo)
            place.append(at - w.first[w.row[at]])
        s = np.concatenate(seed) if seed else np.zeros(0, np.uint64)
        sieve = np.zeros(1 << 20, bool)
        sieve[(s & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        i = np.concatenate(item) if item else np.zeros(0, np.int64)
        p = np.concatenate(place) if place else np.zeros(0, np.int64)
        order = np.lexsort((p, i, s))
        s, i, p = s[order], i[order], p[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (i[1:] != i[:-1])
        return cls(list(ids), hashes, s, i, p, np.flatnonzero(new), sieve)


def tiles(a: np.ndarray, b: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of seed hits: ``a`` and ``b`` are the places, in the two
    texts, of equal runs of ``k`` words.  Returns (place in a, place in b,
    length), longest first; ties go to the earliest place in a, then in b."""
    found = []
    while len(a):
        order = np.lexsort((a, b - a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
        start = np.flatnonzero(new)
        run = np.diff(np.append(start, len(a)))
        best = min(range(len(start)), key=lambda i: (-run[i], a[start[i]], b[start[i]]))
        x, y, n = int(a[start[best]]), int(b[start[best]]), int(run[best]) + k - 1
        found.append((x, y, n))
        free = ((a + k <= x) | (a >= x + n)) & ((b + k <= y) | (b >= y + n))
        a, b = a[free], b[free]
    return found


def tiles_by_length(a: np.ndarray, b: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The same tiling from the word hashes of the two texts, without listing hits:
    the longest common run of unmarked words is found by halving its length, where
    running hashes tell whether a run of that length is common.  Memory is that of
    the texts, also where words repeat."""
    sides = []
    for x in (a, b):
        up, down = powers(len(x) + 1)
        sides.append((np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * up[:-1]))), down))
    gone = [np.zeros(len(a) + 1, np.int64), np.zeros(len(b) + 1, np.int64)]      # marked words before each place

    def runs(side: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        total, down = sides[side]
        m = len(total) - n
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(gone[side][n:] == gone[side][:m])
        return at, (total[at + n] - total[at]) * down[at]

    def common(n: int) -> tuple[int, int] | None:
        (i, p), (j, q) = runs(0, n), runs(1, n)
        hit = np.flatnonzero(np.isin(p, q))
        return (int(i[hit[0]]), int(j[np.argmax(q == p[hit[0]])])) if len(hit) else None

    found = []
    top = min(len(a), len(b))
    while top >= k and common(k):
        low, high = k, top
        while low < high:
            n = (low + high + 1) // 2
            low, high = (n, high) if common(n) else (low, n - 1)
        x, y = common(low)
        found.append((x, y, low))
        for side, at in ((0, x), (1, y)):
            step = np.zeros(len(gone[side]), np.int64)
            step[at + 1:at + low + 1] = 1
            gone[side] += np.cumsum(step)
        top = low
    return found


def _matches(block: Block, column: pa.Array, k: int, least: float) -> Iterator[tuple]:
    """(row, item, covered, tiles) of every pair that reaches ``least``."""
    for lo, hi, buf, offset in chunks(_lower(column)):
        w = _words(buf, offset)
        h = w.hashes()
        value, at = shingle_hashes(w, h, k)
        maybe = np.flatnonzero(block.sieve[(value & np.uint64((1 << 20) - 1)).astype(np.int64)])
        # a seed's entries lie together, those of one item as one group: a row per place and item, not per hit
        left = np.searchsorted(block.seed, value[maybe], "left")
        right = np.searchsorted(block.seed, value[maybe], "right")
        maybe, left, right = maybe[right > left], left[right > left], right[right > left]
        if not len(maybe):
            continue
        left, right = np.searchsorted(block.group, left), np.searchsorted(block.group, right)
        count = right - left
        group = np.repeat(left - np.cumsum(count) + count, count) + np.arange(count.sum())
        place = np.repeat(at[maybe], count)
        row, item = w.row[place], block.item[block.group[group]]
        order = np.lexsort((item, row))
        row, item, place, group = row[order], item[order], place[order], group[order]
        cut = np.flatnonzero((row[1:] != row[:-1]) | (item[1:] != item[:-1])) + 1
        size = np.diff(np.append(block.group, len(block.seed)))
        for s, e in zip(np.append(0, cut), np.append(cut, len(row))):
            r, i = int(row[s]), int(item[s])
            n = len(block.words[i])
            # the seeds alone bound what the tiles can cover
            if int(size[np.unique(group[s:e])].sum()) * k < least * n:
                continue
            each = size[group[s:e]]
            if each.sum() <= _HITS + 4 * (e - s):
                hit = np.repeat(block.group[group[s:e]] - np.cumsum(each) + each, each) + np.arange(each.sum())
                got = tiles(block.place[hit], np.repeat(place[s:e], each) - w.first[r], k)
            else:
                got = tiles_by_length(block.words[i], h[w.first[r]:w.first[r + 1]], k)
            covered = sum(t[2] for t in got)
            if covered >= least * n:
                yield lo + r, i, covered, n, got


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, k: int) -> Iterator[Block]:
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
                             ).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    for i in range(n):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).collect()  # about BLOCK_BYTES
        rows.sort(key=lambda r: (r.id is None, r.id or 0, r.text))
        yield Block.of([r.id for r in rows], [r.text for r in rows], k)


def _each_block(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, k: int,
                use: Callable) -> Iterator:
    for block in _blocks(benchmark, item_col, item_text, k):
        yield use(docs.sparkSession.sparkContext.broadcast(block))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", k: int = SEED,
                 least: float = COVERAGE) -> DataFrame:
    """Pairs (``doc_id``, ``item_id``) with ``item_words``, ``covered`` words,
    ``coverage`` and ``tiles`` (first word in the item, in the document, length)
    where the tiles cover at least ``least`` of the item.

    Null and empty texts match nothing; neither do items of fewer than ``k``
    words.  Equal items count once, a repeated document row gives its pairs
    again, ids may be null, and an empty table gives no rows."""
    src = source(docs, id_col, text_col)

    def pairs(shared) -> DataFrame:
        @tidy
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for b in batches:
                ids = b.column(0)
                rows = [(ids[r].as_py(), block.ids[i], n, covered, covered / n,
                         [{"item": x, "doc": y, "words": z} for x, y, z in got])
                        for r, i, covered, n, got in _matches(block, b.column(1), k, least)]
                if rows:
                    tile = pa.list_(pa.struct([(c, pa.int64()) for c in ("item", "doc", "words")]))
                    types = [pa.int64()] * 4 + [pa.float64(), tile]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                        ["doc_id", "item_id", "item_words", "covered", "coverage", "tiles"])
        return src.mapInArrow(run, "doc_id long, item_id long, item_words long, covered long, coverage double, "
                                   "tiles array<struct<item:long,doc:long,words:long>>")

    out = None
    for part in _each_block(docs, benchmark, item_col, item_text, k, pairs):
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", k: int = SEED, least: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows that cover an item; one pass per block, no shuffle."""
    bounded_batches(docs.sparkSession)
    schema, names = docs.schema, docs.columns

    for block in _blocks(benchmark, item_col, item_text, k):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            at = names.index(text_col)
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for m in _matches(shared.value, b.column(at), k, least):
                    keep[m[0]] = False
                yield b.filter(pa.array(keep))
        docs = docs.mapInArrow(run, schema)
    return docs
