"""Operator 6: exact repeated passages by seed and extend.

Seeds are winnowed anchors: of all runs of ``k`` words, the one of least hash in
every ``w`` runs in a row, with ``k + w - 1 = window`` words.  So every window
holds an anchor, and equal windows hold the same one.

1. Seed.  Anchors that occur in more than one document are found by a join on
   the anchor.  Within a task, all documents of an anchor but one are settled
   at once, so an anchor sends one row per task at most.
2. Extend.  Around each shared anchor a match grows to both sides, over every
   split of the ``window - k`` words that are missing; an extended match is a
   window, and it is looked up among the extensions of the earlier documents.
   Again a task sends one row per distinct window.
3. Windows that begin in a document with a smaller id are merged to maximal
   repeats (spans of words, at least ``window`` long); their words go.

Only documents with a shared anchor are read again.  Text moves through one
shuffle as compressed bytes.  A task settles ``FLUSH`` rows at once, however
long its input is, and holds no more of them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import emit, gathered, group_starts, source, stored, tidy, width
from .words import CHUNK, Words, chunks, mix, shingle_hashes, signed, split_words, window_hashes

WINDOW = 50
SEED = 25
FLUSH = 1 << 18          # anchors or windows that a task settles at once, those of one text chunk more at most
PER_TASK = 1 << 19       # rows a task gets by the shuffles, about
_NULL_ID = np.iinfo(np.int64).max


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NULL_ID).to_numpy(zero_copy_only=False)


def anchors(words: Words, h: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every winnowed anchor: runs of ``k`` words that
    are the last least in some ``window - k + 1`` runs in a row of one row."""
    value, at = shingle_hashes(words, h, k)
    w = window - k + 1
    n = len(value) - w + 1
    if n <= 0:
        return value[:0], at[:0]
    # least (hash, from the right) of every w runs, by doubling the reach
    best = np.arange(len(value))
    reach = 1
    while reach < w:
        step = min(reach, w - reach)
        a, b = best[:len(best) - step], best[step:]
        best = np.where(value[b] <= value[a], b, a)
        reach += step
    inside = at[:n] + w - 1 == at[w - 1:]
    inside &= words.row[at[:n]] == words.row[at[w - 1:]]
    pick = np.unique(best[inside])
    return value[pick], at[pick]


def _text_table(column: pa.Array, lo: int, hi: int) -> pa.Array:
    return column.slice(lo, hi - lo).fill_null("")


def _whole(window: int, k: int):
    """Of every document: id, row key, words, digest of all words."""
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offset in chunks(b.column(1)):
                words = split_words(buf, offset)
                yield from emit(["doc_id", "n_words", "sha"],
                                [b.column(0).slice(lo, hi - lo), words.count,
                                 pa.array([_sha(words, r) for r in range(hi - lo)])])
    return run


def _sha(words: Words, r: int, keep: np.ndarray | None = None) -> str:
    """Digest of a row's kept words, joined by single spaces."""
    a, z = words.first[r], words.first[r + 1]
    buf = words.buf
    if keep is None and a < z:
        lo, hi = words.start[a], words.end[z - 1]
        gaps = words.start[a + 1:z] - words.end[a:z - 1]
        if (gaps == 1).all():
            text = buf[lo:hi].copy()
            text[words.end[a:z - 1] - lo] = 32
            return hashlib.sha256(text).hexdigest()
    pick = np.arange(a, z) if keep is None else a + np.flatnonzero(keep)
    return hashlib.sha256(b" ".join([buf[words.start[i]:words.end[i]].tobytes() for i in pick])).hexdigest()


def _anchor_rows(window: int, k: int):
    """(anchor, doc, settled): per ``FLUSH`` rows of a task one unsettled row of
    each anchor; if several documents in them have it, the others' rows come settled."""
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, held = [], [], 0
        for b in batches:
            ids = _ids(b.column(0))
            for lo, hi, buf, offset in chunks(b.column(1)):
                words = split_words(buf, offset)
                value, at = anchors(words, words.hashes(), window, k)
                keys.append(signed(value))
                docs.append(ids[lo:hi][words.row[at]])
                held += len(at)
                if held >= FLUSH:
                    yield from _first_and_rest(np.concatenate(keys), np.concatenate(docs), True)
                    keys, docs, held = [], [], 0
        if keys:
            yield from _first_and_rest(np.concatenate(keys), np.concatenate(docs), True)
    return run


def _first_and_rest(key: np.ndarray, doc: np.ndarray, both: bool) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = group_starts(key, doc)
    key, doc = key[new], doc[new]
    head = group_starts(key)
    size = np.diff(np.append(np.flatnonzero(head), len(key)))
    many = np.repeat(size, size) > 1
    yield from emit(["key", "doc", "settled", "many"], [key, doc, ~head, many & head])


@tidy
def _shared_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, key) for every anchor in more than one document; a partition holds
    all unsettled rows of its anchors."""
    key, doc, settled, many = gathered(batches, ["key", "doc", "settled", "many"])
    settled = settled.astype(bool)
    yield from emit(["doc", "key"], [doc[settled], key[settled]])
    key, doc, many = key[~settled], doc[~settled], many[~settled].astype(bool)
    order = np.lexsort((doc, key))
    key, doc, many = key[order], doc[order], many[order]
    head = group_starts(key)
    start = np.flatnonzero(head)
    size = np.diff(np.append(start, len(key)))
    hit = (np.repeat(size, size) > 1) | many
    yield from emit(["doc", "key"], [doc[hit], key[hit]])


def _unpacked(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As ``chunks``, of the texts of a batch that ``_pack`` made."""
    packed, size = b.column("packed"), b.column("size").to_numpy(zero_copy_only=False)
    offset = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(offset, offset[lo] + CHUNK, "right")) - 1)
        raw = b"".join([pa.decompress(packed[i].as_py(), int(size[i]), "zstd", asbytes=True) for i in range(lo, hi)])
        yield lo, hi, np.frombuffer(raw, np.uint8), offset[lo:hi + 1] - offset[lo]
        lo = hi


def _extend(window: int, k: int):
    """(window, doc, start word) of the extensions of the shared anchors of each
    document: per ``FLUSH`` rows of a task the earliest document's, the others settled."""
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, starts, held = [], [], [], 0
        for b in batches:
            ids = _ids(b.column("doc_id"))
            seeds, tags = b.column("seeds"), b.column("tag").to_numpy(zero_copy_only=False)
            for lo, hi, buf, offset in _unpacked(b):
                words = split_words(buf, offset)
                h = words.hashes()
                value, at = anchors(words, h, window, k)
                mine = signed(value)
                hit = np.zeros(len(mine), bool)
                row = words.row[at]
                bound = np.searchsorted(row, np.arange(hi - lo + 1))
                for r in range(hi - lo):
                    a, z = bound[r], bound[r + 1]
                    hit[a:z] = np.isin(mine[a:z], seeds[lo + r].values.to_numpy())
                at, row = at[hit], row[hit]
                # every split of the missing words over the two sides
                begin = (at[:, None] - np.arange(window - k + 1)[None, :]).ravel()
                row = np.repeat(row, window - k + 1)
                ok = (begin >= words.first[row]) & (begin + window <= words.first[row + 1])
                begin = np.unique(begin[ok])
                whole, first = window_hashes(words, h, window)
                pick = np.searchsorted(first, begin)
                keys.append(signed(whole[pick]))
                docs.append(ids[lo:hi][words.row[begin]])
                starts.append(begin - words.first[words.row[begin]] + (tags[lo:hi][words.row[begin]] << 32))
                held += len(begin)
                if held >= FLUSH:
                    yield from _earliest(np.concatenate(keys), np.concatenate(docs), np.concatenate(starts))
                    keys, docs, starts, held = [], [], [], 0
        if keys:
            yield from _earliest(np.concatenate(keys), np.concatenate(docs), np.concatenate(starts))
    return run


def _earliest(key: np.ndarray, doc: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((start, doc, key))
    key, doc, start = key[order], doc[order], start[order]
    head = group_starts(key)
    at = np.flatnonzero(head)
    least = np.repeat(doc[at], np.diff(np.append(at, len(key))))
    later = doc > least
    # of the earliest document one row per window goes on, its other places ride with their own rows
    yield from emit(["key", "doc", "start", "settled"], [key, doc, start, later])


@tidy
def _repeats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, start) of the windows that an earlier document has too."""
    key, doc, start, settled = gathered(batches, ["key", "doc", "start", "settled"])
    settled = settled.astype(bool)
    yield from emit(["doc", "start"], [doc[settled], start[settled]])
    key, doc, start = key[~settled], doc[~settled], start[~settled]
    order = np.lexsort((doc, key))
    key, doc, start = key[order], doc[order], start[order]
    head = np.flatnonzero(group_starts(key))
    least = np.repeat(doc[head], np.diff(np.append(head, len(key)))) if len(key) else doc
    later = doc > least
    yield from emit(["doc", "start"], [doc[later], start[later]])


@tidy
def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, for the shuffle."""
    for b in batches:
        for lo in range(0, b.num_rows, 512):
            part = b.slice(lo, 512)
            raw = [(t or "").encode() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([pa.compress(x, "zstd", asbytes=True) for x in raw], pa.binary()),
                 pa.array([len(x) for x in raw], pa.int64()),
                 pa.array([zlib.crc32(x) >> 1 for x in raw], pa.int64())], ["doc_id", "packed", "size", "tag"])


def merge_windows(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal repeats: spans of words covered by windows at sorted starts."""
    starts = np.unique(starts)
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window)
    lo = starts[np.concatenate(([0], cut + 1))]
    hi = starts[np.concatenate((cut, [len(starts) - 1]))] + window
    return list(zip(lo.tolist(), hi.tolist()))


def _cut(window: int):
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, starts = b.column("doc_id"), b.column("starts")
            for lo, hi, buf, offset in _unpacked(b):
                words = split_words(buf, offset)
                rows = []
                for r in range(hi - lo):
                    first = words.first[r]
                    spans = merge_windows(starts[lo + r].values.to_numpy(), window)
                    keep = np.ones(words.first[r + 1] - first, bool)
                    for s, e in spans:
                        keep[s:e] = False
                    text = b" ".join([buf[words.start[i]:words.end[i]].tobytes() for i in first + np.flatnonzero(keep)]).decode()
                    rows.append((docs[lo + r].as_py(), len(keep), int((~keep).sum()), _sha(words, r), text,
                                 [{"first": s, "end": e} for s, e in spans]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                        pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))))],
                    ["doc_id", "n_words", "n_removed", "sha", "kept", "repeats"])
    return run


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      window: int = WINDOW, k: int = SEED) -> DataFrame:
    """The documents that lose words: ``doc_id``, ``n_words``, ``n_removed``,
    ``sha`` (digest of all its words joined by single spaces), ``kept`` (the words left, joined by single spaces) and ``repeats``, the
    maximal repeats as spans of words."""
    spark = docs.sparkSession
    src = source(docs, id_col, text_col)
    n_rows = src.select(F.sum(F.octet_length("text"))).first()[0] or 0
    spread = F.when(F.col("settled"), F.xxhash64("key", "doc")).otherwise(F.col("key"))
    seeds = (src.mapInArrow(_anchor_rows(window, k), "key long, doc long, settled boolean, many boolean")
             .repartition(width(spark, n_rows / 60, PER_TASK), spread)
             .mapInArrow(_shared_anchors, "doc long, key long")
             .groupBy("doc").agg(F.collect_list("key").alias("seeds")))
    packed = src.mapInArrow(_pack, "doc_id long, packed binary, size long, tag long")
    again = stored(packed.join(seeds, F.coalesce("doc_id", F.lit(_NULL_ID)) == F.col("doc"))
                   .select("doc_id", "packed", "size", "tag", "seeds"), "passage-texts")
    found = (again.mapInArrow(_extend(window, k), "key long, doc long, start long, settled boolean")
             .repartition(width(spark, n_rows / 30, PER_TASK), spread)
             .mapInArrow(_repeats, "doc long, start long")
             .withColumn("of", F.shiftright("start", 32))
             .groupBy("doc", "of").agg(F.collect_list(F.expr("start & 4294967295")).alias("starts")))
    return (again.join(found, (F.coalesce("doc_id", F.lit(_NULL_ID)) == F.col("doc")) & (F.col("tag") == F.col("of")))
            .select("doc_id", "packed", "size", "starts")
            .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, sha string, kept string, "
                                      "repeats array<struct<first:long,end:long>>"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
           k: int = SEED) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and
    ``kept_sha256`` of the words left.

    Null or empty text: no words, the digest of nothing.  A null id counts as
    larger than every id.  Rows of one id, with equal or different texts, never
    remove from each other, and come out as often as they went in."""
    src = source(docs, id_col, text_col)
    cut = stored(repeated_passages(docs, id_col, text_col, window, k)
                 .select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("key"), "sha", "n_removed", F.sha2("kept", 256).alias("cut_sha")).distinct(), "passage-cuts")
    whole = src.mapInArrow(_whole(window, k), "doc_id long, n_words long, sha string")
    return (whole.withColumn("key", F.coalesce("doc_id", F.lit(_NULL_ID)))
            .join(cut, ["key", "sha"], "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("cut_sha", "sha").alias("kept_sha256")))
