"""Operator 11: phrases of two to four words that stand together more often
than their parts do, per language.

Texts are cut at punctuation and line ends into pieces and those into words.
Every run of words has a Rabin-Karp fingerprint: with prefix polynomials over
the word hashes, one subtraction and one product give the fingerprint of a run
of any length, for all places of a block at once in numpy.

1. Fingerprints of one word are counted: each task counts its own in numpy and
   ships them in blocks of four bytes a fingerprint and one a count; the shuffle
   brings together the blocks of a range of fingerprints, and one that a third of
   all texts hold is one entry per task.
2. The frequent ones set bits in a bitmap of fixed size (``BITMAP`` bits, the
   only thing that is broadcast).  A run of n words can only be frequent if both
   its runs of n - 1 words are, so the next count leaves the others out.  This goes
   on to four words.  Here fingerprints that collide, when shortened or in the
   bitmap, only let a run through that is not frequent: nothing is lost.
3. A last pass visits the runs whose fingerprints may be frequent, tells their
   words apart by their bytes (not by hashes), and cuts each distinct phrase from
   the text at one occurrence per block.  The shuffle adds up the counts of equal
   phrases, with a pointer to a document that has one: runs that share a
   fingerprint part here, and the counts are those of the texts.
4. Cuts, scores and the containment rule are joins over the frequent phrases.

Nulls, empty and blank texts have no words; a null language is ``und``; repeated
rows count as often as they occur; an empty table gives no rows; other columns
are not looked at.  A text is held whole by one task, with a few arrays a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .tables import stored

LONGEST = 4              # words of the longest phrase
MIN_COUNT = 30
TOP = 2000
BITMAP = 1 << 26         # bits of a level's bitmap: 8 MB at every size of the corpus
_COUNTED = 1 << 22       # fingerprints that a task holds before it counts them
_LAST_BLOCK = 4 << 20    # text bytes whose phrases a task holds at once
_UNKNOWN = "und"

# What ends a piece, and what ends a word besides.
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_ENDS_WORD = _ENDS_PIECE.copy()
_ENDS_WORD[[0x20, 0x09]] = True


class Block:
    """The words of some texts, with prefix polynomials over their hashes."""

    def __init__(self, buf: np.ndarray, offset: np.ndarray, lang_hash: np.ndarray) -> None:
        self.words = w = W.split_words(W.LOWER[buf], offset, _ENDS_WORD)
        self.piece = np.cumsum(_ENDS_PIECE[buf])[w.start]
        self.hash = w.hashes()
        self.up, self.down = W.powers(len(self.hash) + 1)
        self.prefix = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * self.up[:-1], out=self.prefix[1:])
        self.lang = lang_hash

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and first word of every run of ``n`` words of a piece."""
        last = len(self.hash) - n + 1
        if last <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        row = self.words.row
        at = np.flatnonzero((self.piece[:last] == self.piece[n - 1:]) & (row[:last] == row[n - 1:]))
        value = (self.prefix[at + n] - self.prefix[at]) * self.down[at]
        return W.mix(value ^ W.mix(self.lang[row[at]] + np.uint64(n))), at


def _blocks(batches: Iterable[pa.RecordBatch], size: int = W.CHUNK) -> Iterator[tuple[pa.RecordBatch, int, Block]]:
    for b in batches:
        codes = b.column(2).dictionary_encode()
        buf, offset = W.text_bytes(codes.dictionary)
        lang = W.hash_spans(buf, offset[:-1], offset[1:])[codes.indices.to_numpy()]
        for lo, hi, buf, offset in W.chunks(b.column(1), size):
            yield b, lo, Block(buf, offset, lang[lo:hi])


def _short(key: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` + 32 bits of fingerprints, by which they are counted:
    ``width`` name the range that a task adds up, 32 are shipped."""
    return key >> np.uint64(32 - width)


class Bitmap:
    """Fingerprints that may be frequent."""

    def __init__(self, width: int, bits: np.ndarray | None = None) -> None:
        self.width = width
        self.bits = np.zeros(BITMAP // 64, np.uint64) if bits is None else bits

    def holds(self, key: np.ndarray) -> np.ndarray:
        slot = _short(key, self.width) & np.uint64(BITMAP - 1)
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _frequent(block: Block, n: int, bitmap: Bitmap) -> np.ndarray:
    """Mask over words: a run of ``n`` words that may be frequent begins here."""
    key, at = block.runs(n)
    out = np.zeros(len(block.hash) + 1, bool)
    out[at] = bitmap.holds(key)
    return out


def _counted(texts: DataFrame, n: int, below, width: int, least: int) -> DataFrame:
    """(range, keys, counts): fingerprints of runs of ``n`` words, counted per task
    and up to ``least``; ``below`` is the broadcast bitmap of the runs that are one
    word shorter."""
    kind = np.uint8 if least < 256 else np.uint32

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def rows() -> pa.RecordBatch:
            key, c = np.unique(np.concatenate(held), return_counts=True)
            bound = np.searchsorted(key >> np.uint64(32), np.arange((1 << width) + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(bound))
            key, c = (key & np.uint64(0xFFFFFFFF)).astype("<u4"), np.minimum(c, least).astype(kind)
            cuts = [slice(bound[i], bound[i + 1]) for i in some.tolist()]
            return pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([key[x].tobytes() for x in cuts]), pa.array([c[x].tobytes() for x in cuts])],
                ["range", "keys", "counts"])

        for _, _, block in _blocks(batches):
            key, at = block.runs(n)
            if below is not None and len(at):
                may = _frequent(block, n - 1, below.value)
                key = key[may[at] & may[at + 1]]
            held.append(_short(key, width))
            size += len(key)
            if size >= _COUNTED:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    return texts.mapInArrow(run, "range long, keys binary, counts binary")


def _set_bits(least: int):
    """(at, bits): the words of the bitmap that the frequent fingerprints of a
    partition's ranges set."""
    kind = np.uint8 if least < 256 else np.uint32

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple[bytes, bytes]]] = {}
        for b in batches:
            for r, keys, counts in zip(*(c.to_pylist() for c in b.columns)):
                parts.setdefault(r, []).append((keys, counts))
        slots = [np.zeros(0, np.uint64)]
        while parts:
            r, blobs = parts.popitem()
            key = np.frombuffer(b"".join(k for k, _ in blobs), "<u4")
            count = np.frombuffer(b"".join(c for _, c in blobs), kind)
            order = np.argsort(key, kind="stable")
            key, count = key[order], count[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            often = key[first[np.add.reduceat(count, first) >= least]].astype(np.uint64)
            slots.append(((np.uint64(r) << np.uint64(32)) | often) & np.uint64(BITMAP - 1))
        slot = np.unique(np.concatenate(slots))
        if len(slot):
            at = slot >> np.uint64(6)
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            bits = np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), first)
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(at[first])), pa.array(W.signed(bits))], ["at", "bits"])

    return run


def _bitmap(texts: DataFrame, n: int, below, least: int):
    """Broadcast bitmap of the fingerprints of ``n`` words that come ``least`` times
    or more; at most ``BITMAP / 64`` numbers reach the driver."""
    spark = texts.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bitmap = Bitmap(min(24, max(8, (4 * tasks).bit_length())))
    got = (_counted(texts, n, below, bitmap.width, least).repartition(tasks, "range")
           .mapInArrow(_set_bits(least), "at long, bits long")
           .groupBy("at").agg(F.bit_or("bits").alias("bits"))).toArrow()
    bitmap.bits[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bitmap)


def _gathered(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of spans, one after another."""
    ends = np.cumsum(size)
    return buf[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)]


def _word_ids(block: Block, chosen: np.ndarray) -> np.ndarray:
    """Numbers of the chosen words, equal where and only where their bytes are."""
    w = block.words
    start, size = w.start[chosen], (w.end - w.start)[chosen]
    _, first, ids = np.unique(block.hash[chosen], return_index=True, return_inverse=True)
    model = first[ids]
    same = size == size[model]
    i = np.flatnonzero(same)
    differs = _gathered(w.buf, start[i], size[i]) != _gathered(w.buf, start[model[i]], size[i])
    if differs.any():
        same[i[np.unique(np.repeat(np.arange(len(i)), size[i])[differs])]] = False
    others: dict[bytes, int] = {}                     # words that share a hash with another word
    for j in np.flatnonzero(~same):
        raw = w.buf[start[j]:start[j] + size[j]].tobytes()
        ids[j] = others.setdefault(raw, len(first) + len(others))
    return ids


def _ordered(block: Block, ids: np.ndarray) -> np.ndarray:
    """Word numbers in the byte order of the words, so that phrases come out in
    order and compress well on their way."""
    w = block.words
    some = np.flatnonzero(ids >= 0)
    if not len(some):
        return ids
    values, first = np.unique(ids[some], return_index=True)
    at = some[first]
    size = (w.end - w.start)[at]
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets),
                                                                         pa.py_buffer(_gathered(w.buf, w.start[at], size))])
    rank = np.full(int(values[-1]) + 1, -1, np.int64)
    rank[values[pc.array_sort_indices(text).to_numpy()]] = np.arange(len(values))
    return np.where(ids >= 0, rank[ids], -1)


def _phrases(block: Block, levels: list[Bitmap], lang_ids: np.ndarray) -> Iterator[tuple]:
    """(n, phrases, counts, first words) of the runs that may be frequent; runs are
    grouped by language and by the bytes of their words."""
    w = block.words
    if not len(w.start):
        return
    may = _frequent(block, 1, levels[0])
    chosen = np.flatnonzero(may)
    ids = np.full(len(w.start), -1, np.int64)
    ids[chosen] = _word_ids(block, chosen)
    ids = _ordered(block, ids)
    base = int(ids.max(initial=0)) + 1
    group = np.full(len(w.start), -1, np.int64)
    group[chosen] = lang_ids[w.row[chosen]]
    size = w.end - w.start
    place = np.concatenate(([0], np.cumsum(size + 1)))      # of the words in a text with single spaces
    even = np.full(int(place[-1]), 32, np.uint8)
    total = int(size.sum())
    even[np.arange(total) + np.repeat(np.arange(len(size)), size)] = _gathered(w.buf, w.start, size)
    for n, bitmap in enumerate(levels, 1):
        if n > 1:
            may = _frequent(block, n, bitmap) & may & np.append(may[1:], False)
            chosen = np.flatnonzero(may)
        if not len(chosen):
            return
        _, first, inverse, count = np.unique(group[chosen] * base + ids[chosen + n - 1], return_index=True,
                                             return_inverse=True, return_counts=True)
        group[:] = -1
        group[chosen] = inverse
        at = chosen[first]
        length = place[at + n] - 1 - place[at]
        offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
        text = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(_gathered(even, place[at], length)))
        yield n, text, count, at


def phrase_counts(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, n, phrase, a, doc_id): all phrases of one to ``longest`` words that
    come ``min_count`` times or more in a language, each with the id of one
    document that has it; and per language a row of ``n = 0`` with the number of
    its words.  Written to the shared folder."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.coalesce(F.col(lang_col).cast("string"), F.lit(_UNKNOWN)).alias("lang"))
    levels: list = []
    for n in range(1, longest + 1):
        levels.append(_bitmap(texts, n, levels[-1] if levels else None, min_count))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [x.value for x in levels]
        for b, lo, block in _blocks(batches, _LAST_BLOCK):
            rows = len(block.lang)
            codes = b.column(2).slice(lo, rows).dictionary_encode()
            lang_ids = codes.indices.to_numpy().astype(np.int64)
            heads = pc.binary_join_element_wise(codes.dictionary, "", "\t")     # no word holds a tab
            doc = b.column(0).slice(lo, rows)
            held = np.bincount(lang_ids, np.diff(block.words.first), len(heads)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([heads, pa.array(held), pa.nulls(len(held), pa.int64())], ["phrase", "c", "doc_id"])
            row = block.words.row
            for _, text, count, at in _phrases(block, bitmaps, lang_ids):
                head = heads.take(pa.array(lang_ids[row[at]]))
                yield pa.RecordBatch.from_arrays(
                    [pc.binary_join_element_wise(head, text, ""), pa.array(count), doc.take(pa.array(row[at]))],
                    ["phrase", "c", "doc_id"])

    counts = texts.mapInArrow(run, "phrase string, c long, doc_id long").groupBy("phrase").agg(
        F.sum("c").alias("a"), F.min("doc_id").alias("doc_id"))
    tail = F.substring_index("phrase", "\t", -1)
    words = F.when(tail == "", 0).otherwise(F.size(F.split(tail, " ")))
    named = counts.select(F.expr("left(phrase, length(phrase) - length(substring_index(phrase, '\t', -1)) - 1)").alias("lang"),
                          words.alias("n"), tail.alias("phrase"), "a", "doc_id")
    return stored(named.where((F.col("n") == 0) | (F.col("a") >= min_count)), "phrase-counts")


_WIDE = "DECIMAL(20,0)"


def _scored(counts: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut (l, r, score)."""
    part = counts.where("n > 0").select("lang", F.col("phrase").alias("part"), F.col("a").alias("c"))
    cuts = (counts.where("n > 1").select("lang", "phrase", "n", "a", "doc_id", F.split("phrase", " ").alias("w"),
                                         F.explode(F.expr("sequence(1, n - 1)")).alias("k"))
            .select("lang", "phrase", "n", "a", "doc_id", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"),
                    F.expr("array_join(slice(w, k + 1, n - k), ' ')").alias("right")))
    both = (cuts.join(part.withColumnsRenamed({"part": "left", "c": "l"}), ["lang", "left"])
            .join(part.withColumnsRenamed({"part": "right", "c": "r"}), ["lang", "right"]))
    score = f"CAST(2000000 AS {_WIDE}) * CAST(a AS {_WIDE}) div (CAST(l AS {_WIDE}) + CAST(r AS {_WIDE}))"
    return (both.withColumn("score", F.expr(score)).groupBy("lang", "phrase", "n", "a", "doc_id")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "n", "a", "doc_id", "cut.score", "cut.l", "cut.r"))


def _covered(counts: DataFrame) -> DataFrame:
    """(lang, phrase, most): the count of the commonest longer candidate that
    holds the phrase."""
    inner = (counts.where("n > 2").select("lang", "a", "n", F.split("phrase", " ").alias("w"))
             .select("lang", "a", "n", "w", F.explode(F.expr("sequence(2, n - 1)")).alias("size"))
             .select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, n - size + 1)")).alias("from")))
    return (inner.select("lang", "a", F.expr("array_join(slice(w, from, size), ' ')").alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("most")))


def _first(df: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language: winners of hashed groups, then of
    fewer groups, so no task sorts a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for groups in (wide, 16, 1):
        w = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(groups))).orderBy(*order)
        df = df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return df


def collocations(docs: DataFrame, top: int = TOP, longest: int = LONGEST, min_count: int = MIN_COUNT,
                 **columns: str) -> DataFrame:
    """The ``top`` candidates of each language: ``lang``, ``rank``, ``phrase``,
    ``a`` (its count), ``l`` and ``r`` (counts of the two parts of its
    lowest-scoring cut), ``n`` (words of the language), ``score`` =
    floor(2000000 * a / (l + r)), and ``doc_id``, a document with an occurrence.

    A candidate that a longer one holds goes if the longer one comes at least 80
    percent as often.  Products are decimals of 38 digits.  Among equal scores the
    smaller first part counts for a cut, and count, then byte order for a rank."""
    counts = phrase_counts(docs, longest, min_count, **columns)
    kept = (_scored(counts).join(_covered(counts), ["lang", "phrase"], "left")
            .where(f"most IS NULL OR CAST(most AS {_WIDE}) * 100 < CAST(a AS {_WIDE}) * 80"))
    total = counts.where("n = 0").select("lang", F.col("a").alias("n"))
    return (_first(kept.drop("n", "most"), top).join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
                    "doc_id"))
