"""Operator 13: resampling of documents towards a target distribution.

Features are words and pairs of neighbouring words, hashed by CRC-32 into
buckets.  Three steps: the buckets of all documents and of all target texts are
counted (a row per bucket and task is shuffled); the gain of a bucket compares
both; each document gets the mean gain of its features plus a Gumbel draw made
from its id, and the highest scores win (sampling without replacement).

CRC-32 is linear over XOR: the checksum of a byte string is the XOR of one number
per byte, which depends on the byte and its distance from the end, and of one
number that depends on the length.  ``_Crc`` keeps both in tables, looks all
bytes of a block up at once and folds each feature's span with
``bitwise_xor.reduceat``.  Spans longer than the table are cut into blocks from
their end, and a block's value is moved on by the zero bytes behind it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .tables import stored

BUCKETS = 10_000
_REACH = 128             # bytes from the end of a span that the table covers

# Fixed value: the reversed polynomial of CRC-32.
_POLYNOMIAL = 0xEDB88320

# Bytes that end a word (the text is in lower case): ASCII but for digits and letters.
_BETWEEN = np.zeros(256, bool)
_BETWEEN[:0x80] = True
_BETWEEN[0x30:0x3A] = False
_BETWEEN[0x61:0x7B] = False


class _Crc:
    """CRC-32 of many byte spans at once."""

    def __init__(self, reach: int = _REACH) -> None:
        one = np.arange(256, dtype=np.uint32)                 # what a last byte contributes
        for _ in range(8):
            one = (one >> np.uint32(1)) ^ (np.uint32(_POLYNOMIAL) * (one & np.uint32(1)))
        self.reach, self.one = reach, one
        table = np.empty((reach, 256), np.uint32)
        table[0] = one
        for d in range(1, reach):
            table[d] = self._zero(table[d - 1])
        self.table = table.ravel()
        # the register, moved on by ``reach`` zero bytes, as a look-up of each of its four bytes
        byte = np.arange(256, dtype=np.uint32)
        self.ahead = np.stack([self._moved(byte << np.uint32(8 * k), reach) for k in range(4)])
        start = np.full(1, 0xFFFFFFFF, np.uint32)
        self.constant = np.empty(reach + 1, np.uint32)        # of a length: the initial register moved through it
        for n in range(reach + 1):
            self.constant[n] = start[0]
            start = self._zero(start)

    def _zero(self, x: np.ndarray) -> np.ndarray:
        return self.one[x & np.uint32(255)] ^ (x >> np.uint32(8))

    def _moved(self, x: np.ndarray, n: int) -> np.ndarray:
        for _ in range(n):
            x = self._zero(x)
        return x

    def _block_ahead(self, x: np.ndarray) -> np.ndarray:
        out = self.ahead[0][x & np.uint32(255)]
        for k in (1, 2, 3):
            out = out ^ self.ahead[k][(x >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def _short(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """XOR of the contributions of ordered spans of 1 to ``reach`` bytes that
        don't overlap."""
        lo, hi = int(start[0]), int(end[-1])
        owner = np.repeat(end, np.diff(np.append(start, hi)))   # bytes between spans count to the one before
        distance = owner - 1 - np.arange(lo, hi)
        value = self.table[np.maximum(distance, 0) * 256 + buf[lo:hi]]
        edges = np.empty(2 * len(start), np.int64)
        edges[::2], edges[1::2] = start - lo, end - lo
        return np.bitwise_xor.reduceat(value, edges[:-1])[::2]      # the last span goes to the end

    def of_spans(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """CRC-32 of ``buf[start:end]`` for ordered, non-empty spans that don't overlap."""
        if not len(start):
            return np.zeros(0, np.uint32)
        size = end - start
        out = np.empty(len(start), np.uint32)
        short = np.flatnonzero(size <= self.reach)
        if len(short) == len(start):
            out = self._short(buf, start, end) ^ self.constant[size]
        elif len(short):
            out[short] = self._by_place(buf, start[short], end[short]) ^ self.constant[size[short]]
        for i in np.flatnonzero(size > self.reach):
            out[i] = self._long(buf[start[i]:end[i]])
        return ~out

    def _by_place(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """As ``_short`` where long spans stand between the short ones."""
        size = end - start
        begins = np.cumsum(size) - size
        own = buf[np.arange(int(size.sum())) + np.repeat(start - begins, size)]
        return self._short(own, begins, begins + size)

    def _long(self, span: np.ndarray) -> np.uint32:
        """Blocks of ``reach`` bytes counted from the end, the first one shorter;
        their values by ``reduceat``, then one after the other."""
        first = len(span) % self.reach or self.reach
        cuts = np.concatenate(([0], np.arange(first, len(span) + 1, self.reach)))
        blocks = self._short(span, cuts[:-1], cuts[1:])
        state = self.constant[first:first + 1] ^ blocks[:1]
        for k in range(1, len(blocks)):
            state = self._block_ahead(state) ^ blocks[k]
        return state[0]


_CRC = _Crc()


def _even(words: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with one space between them, as bytes, starts and ends."""
    size = words.end - words.start
    end = np.cumsum(size + 1) - 1
    start = end - size
    out = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
    total = np.arange(int(size.sum()))
    before = np.cumsum(size) - size
    out[total + np.repeat(start - before, size)] = words.buf[total + np.repeat(words.start - before, size)]
    return out, start, end


def feature_buckets(buf: np.ndarray, offset: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every word and every pair of neighbouring words of the
    texts ``buf[offset[r]:offset[r + 1]]``, and the words of each row."""
    words = W.split_words(W.LOWER[buf], offset, _BETWEEN)
    even, start, end = _even(words)
    row = words.row
    rows, crcs = [row], [_CRC.of_spans(even, start, end)]
    pair = np.flatnonzero(row[:-1] == row[1:])
    for side in (0, 1):                                   # pairs that begin at even and at odd words don't overlap
        p = pair[pair % 2 == side]
        rows.append(row[p])
        crcs.append(_CRC.of_spans(even, start[p], end[p + 1]))
    return np.concatenate(rows), np.concatenate(crcs) % np.uint32(buckets), words.count


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without any are left
    out.  Null texts have no features, repeated rows count again."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, buf, offset in W.chunks(b.column(0)):
                held += np.bincount(feature_buckets(buf, offset, buckets)[1], minlength=buckets)
        at = np.flatnonzero(held)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["bucket", "n"])

    return (texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text",
          buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every
    bucket, as an array of ``buckets`` numbers (all that reaches the driver)."""
    counts = []
    for table, col in ((docs, text_col), (target, target_col)):
        got = bucket_counts(table, col, buckets).toArrow()
        n = np.zeros(buckets)
        n[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
        counts.append(n)
    s, t = counts
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of a
    document's features, 0 without any; a row per row of ``docs``."""
    buckets = len(gain)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offset in W.chunks(b.column(1)):
                row, bucket, n_words = feature_buckets(buf, offset, buckets)
                n = np.bincount(row, minlength=hi - lo)
                total = np.bincount(row, gain[bucket], hi - lo).astype(np.int64)     # exact: far below 2 ** 53
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n_words), pa.array(n), pa.array(total // np.maximum(n, 1))],
                    ["doc_id", "n_words", "n_features", "weight"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def _ranked(scored: DataFrame, share: int, min_words: int) -> DataFrame:
    """``rank`` of the drawn documents, by score and then id, without one task
    that sorts them all: scores are whole numbers within a fixed range (the gains
    and the draw are logarithms), so the documents before each score come from a
    table of counts by score, and a window ranks those of one score."""
    able = F.col("n_words") >= min_words
    by_score = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("here"))
    upto = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = stored(by_score.withColumn("upto", F.sum("here").over(upto)), "score-counts")
    drawn = counts.agg(F.expr(f"coalesce(max(upto), 0) * {share} div 100")).first()[0]
    starts = counts.where(F.col("upto") - F.col("here") < drawn).select("score", (F.col("upto") - F.col("here")).alias("before"))
    lowest = starts.agg(F.min("score")).first()[0]
    if lowest is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    hopeful = able & (F.col("score") >= lowest)
    place = (scored.where(hopeful).join(starts, "score")
             .withColumn("rank", F.col("before") + F.row_number().over(
                 Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"))))
             .withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long")))
    names = [*scored.columns, "rank"]
    return place.select(*names).unionByName(
        scored.where(~F.coalesce(hopeful, F.lit(False))).withColumn("rank", F.lit(None).cast("long")).select(*names))


def resampled(docs: DataFrame, target: DataFrame, share: int = 25, min_words: int = 20, seed: int = 7,
              buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text",
              target_col: str = "text") -> DataFrame:
    """Every document with ``n_features``, ``weight``, ``score`` and ``rank``
    (null if it isn't drawn): of the N documents of at least ``min_words`` words
    the floor(share * N / 100) highest scores are drawn.

    Null and empty texts have no features and weight 0; a null id draws from
    ``<seed>:`` and comes last among equal scores; repeated rows are documents of
    their own with the same score, in any order; empty tables on either side
    count as zero features; other columns are not looked at."""
    gain = gains(docs, target, text_col, target_col, buckets)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    unit = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    draw = F.floor(-1000 * F.log(-F.log(unit)))
    scored = weighted(docs, gain, id_col, text_col).withColumn("score", (F.col("weight") + draw).cast("long"))
    return _ranked(stored(scored, "scored"), share, min_words)
