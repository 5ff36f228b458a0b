"""Operator 1: line deduplication by pairwise alignment.

1. Lines (without their white space at the ends) are hashed, and so are the runs
   of neighbouring lines that are long enough to be deleted: ``min_lines`` lines,
   or fewer of at least ``min_chars`` bytes.  A run that stands in several
   documents belongs to the first of them, its owner.
2. A run joins its document with the owner.  So a document meets the first holder
   of each of its runs once, also where every line of a run was seen elsewhere
   before; a group of copies makes one pair per copy, and no pairs among the copies.
3. Each pair is aligned by patience: lines that are unique in both are matched
   by their longest increasing sequence, the gaps between are aligned in the same
   way, matches grow over equal neighbours, and a gap without unique lines is
   aligned by its longest equal run.
4. Aligned blocks of at least ``min_lines`` lines, or ``min_chars`` bytes, are
   deleted from the later document.  Every deletion is a block of an alignment.
5. An alignment matches each line once and in order.  With ``every_copy``, the
   places of the later document that still keep lines of a run of the earlier one
   are aligned with the whole earlier document again, until none is left: copies
   that are repeated or stand in another order go too.  So a line goes if, and only
   if, it is in a run that an earlier document holds.  Without it, all runs and
   lines that documents share make pairs, and each pair is aligned once.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .tables import bounded_batches, source, stored, tidy, unused
from .texts import expand, squeeze
from .words import _BASE, SEPARATOR, chunks, hash_spans, mix, powers, signed

MIN_LINES = 2
MIN_CHARS = 200


def _lines(buf: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, number in the row, trimmed start and end of every line with a word."""
    edge = np.zeros(len(buf) + 1, bool)
    edge[offset] = True
    edge[np.flatnonzero(buf == 10) + 1] = True
    start = np.flatnonzero(edge[:-1])
    solid = np.flatnonzero(~SEPARATOR[buf])
    first = np.searchsorted(solid, start)
    last = np.searchsorted(solid, np.append(start[1:], len(buf)))
    row = np.searchsorted(offset, start, "right") - 1
    has = last > first
    heads = np.searchsorted(start, offset)
    number = np.arange(len(start)) - heads[row]
    return row[has], number[has], solid[first[has]], solid[last[has] - 1] + 1


def _runs(line: np.ndarray, chars: np.ndarray, end: np.ndarray, min_lines: int,
          min_chars: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length: lines, first lines and hashes of the runs that can be deleted,
    ``min_lines`` lines or fewer of at least ``min_chars`` bytes; ``end`` is the
    end of the document of each line."""
    key = np.zeros(len(line), np.uint64)
    total = np.concatenate(([0], np.cumsum(chars, dtype=np.int64)))
    for n in range(1, max(min_lines, 1) + 1):
        at = np.flatnonzero(np.arange(n, len(line) + n) <= end)
        if not len(at):
            return
        key[at] = mix(key[at] * _BASE + line[at + n - 1])
        long = at if n >= min_lines else at[total[at + n] - total[at] >= min_chars]
        yield n, long, key[long]


def _line_table(min_lines: int, min_chars: int):
    """Per document: its key, the hashes, numbers and lengths of its lines, and
    the hashes of its runs."""
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            for lo, hi, buf, offset in chunks(b.column(1)):
                row, number, start, end = _lines(buf, offset) if len(buf) else (np.zeros(0, np.int64),) * 4
                h = hash_spans(buf, start, end)
                rows = np.arange(hi - lo + 1)
                bound = np.searchsorted(row, rows)
                runs = list(_runs(h, end - start, bound[1:][row], min_lines, min_chars))
                at = np.concatenate([np.zeros(0, np.int64), *(x for _, x, _ in runs)])
                order = np.argsort(at, kind="stable")
                key = np.concatenate([np.zeros(0, np.uint64), *(x for _, _, x in runs)])[order]
                run_bound = np.searchsorted(row[at[order]], rows)
                text = hash_spans(buf, offset[:-1], offset[1:])
                cols = [pa.ListArray.from_arrays(pa.array(n, pa.int32()), pa.array(x, t)) for n, x, t in (
                    (bound, signed(h), pa.int64()), (bound, number.astype(np.int32), pa.int32()),
                    (bound, (end - start).astype(np.int32), pa.int32()), (run_bound, signed(key), pa.int64()))]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(signed(text)), *cols],
                                                 ["doc_id", "text_key", "line", "number", "chars", "run"])
    return run


def longest_run(a: list, b: list) -> tuple[int, int, int]:
    """(in a, in b, lines) of the longest run of neighbouring lines that both
    have; the first one in b.  Both have some line in common."""
    sides = []
    number: dict = {}
    for x in (a, b):
        line = mix(np.array([number.setdefault(v, len(number)) for v in x], np.uint64) + np.uint64(1))
        up, down = powers(len(line) + 1)
        sides.append((np.concatenate((np.zeros(1, np.uint64), np.cumsum(line * up[:-1]))), down))

    def common(n: int) -> tuple[int, int] | None:
        p, q = ((total[n:] - total[:-n]) * down[:len(total) - n] for total, down in sides)
        at = np.flatnonzero(np.isin(q, p))
        return (int(np.argmax(p == q[at[0]])), int(at[0])) if len(at) else None

    low, high = 1, min(len(a), len(b))
    while low < high:
        n = (low + high + 1) // 2
        low, high = (n, high) if common(n) else (low, n - 1)
    return (*common(low), low)


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched positions (in a, in b), increasing in both.

    Lines that are unique on both sides match by their longest increasing
    sequence; the gaps between are aligned in the same way, after matches have
    grown into them; a gap without such lines by its longest equal run."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b), False, False)]         # the last two: is the gap bounded by a match there
    while work:
        lo, hi, x, y, left, right = work.pop()
        while left and lo < hi and x < y and a[lo] == b[x]:
            out.append((lo, x))
            lo, x = lo + 1, x + 1
        while right and lo < hi and x < y and a[hi - 1] == b[y - 1]:
            hi, y = hi - 1, y - 1
            out.append((hi, y))
        in_a, in_b = Counter(a[lo:hi]), Counter(b[x:y])
        if in_a.keys().isdisjoint(in_b):
            continue
        at = {v: i for i, v in enumerate(b[x:y], x) if in_b[v] == 1}
        both = [(i, at[v]) for i, v in enumerate(a[lo:hi], lo) if in_a[v] == 1 and v in at]
        if not both:
            i, j, n = longest_run(a[lo:hi], b[x:y])
            chain = [(lo + i + k, x + j + k) for k in range(n)]
        else:
            chain = _increasing(both)
        out += chain
        ends = [(lo - 1, x - 1), *chain, (hi, y)]
        for k, ((i, j), (i2, j2)) in enumerate(zip(ends[:-1], ends[1:])):
            if i + 1 < i2 and j + 1 < j2:
                work.append((i + 1, i2, j + 1, j2, k > 0 or left, k < len(chain) or right))
    out.sort()
    return out


def _increasing(both: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, ordered by the first number, that ascends in the second."""
    ends: list[int] = []
    tops: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(both):
        k = bisect_left(ends, j)
        back.append(tops[k - 1] if k else -1)
        if k == len(ends):
            ends.append(j)
            tops.append(n)
        else:
            ends[k], tops[k] = j, n
    chain = []
    n = tops[-1]
    while n >= 0:
        chain.append(both[n])
        n = back[n]
    return chain[::-1]


def blocks(matched: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Maximal runs (in a, in b, lines) of matches that are neighbours in both."""
    out: list[list[int]] = []
    for i, j in matched:
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1][2] += 1
        else:
            out.append([i, j, 1])
    return [tuple(x) for x in out]


def deleted(theirs: list[int], mine: list[int], size: np.ndarray, min_lines: int, min_chars: int,
            held: np.ndarray | None = None) -> np.ndarray:
    """Mask of the lines of the later document (``mine``, of ``size`` bytes each)
    that lie in aligned blocks.

    With ``held``, the hashes of the runs of the earlier document, the places where
    the later one still keeps lines of such a run are aligned with the whole
    earlier document again, until none is left: first all neighbouring places
    together, and where that deletes nothing each run by itself."""
    drop = np.zeros(len(size), bool)

    def align(lo: int, hi: int) -> None:
        for _, j, n in blocks(patience(theirs, mine[lo:hi])):
            part = slice(lo + j, lo + j + n)
            if n >= min_lines or int(size[part].sum()) >= min_chars:
                drop[part] = True

    align(0, len(mine))
    if held is None or drop.all():
        return drop
    line = np.array(mine, np.int64).view(np.uint64)
    found = [(at[np.isin(h, held)], n) for n, at, h in _runs(line, size, np.full(len(line), len(line)), min_lines, min_chars)]
    first = np.concatenate([at for at, _ in found])
    last = np.concatenate([at + n for at, n in found])
    order = np.argsort(first, kind="stable")
    first, last = first[order], last[order]
    alone = False
    while True:
        kept = np.concatenate(([0], np.cumsum(~drop)))
        some = kept[last] > kept[first]
        first, last = first[some], last[some]
        if not len(first):
            return drop
        if alone:
            places = zip(first.tolist(), last.tolist())
        else:
            head = np.flatnonzero(np.concatenate(([True], first[1:] >= np.maximum.accumulate(last)[:-1])))
            places = zip(first[head].tolist(), np.maximum.reduceat(last, head).tolist())
        for lo, hi in places:
            align(lo, hi)
        if int(drop.sum()) + int(kept[-1]) == len(drop):       # nothing new
            if alone:
                return drop
            alone = True
        else:
            alone = False


def _align(min_lines: int, min_chars: int, every_copy: bool):
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts, gone = [], [], []
            for key, text, mine, number, chars, theirs, held in zip(*(b.column(c) for c in (
                    "later", "text_key", "line", "number", "chars", "owned", "held"))):
                drop = deleted(theirs.values.to_pylist(), mine.values.to_pylist(), chars.values.to_numpy(), min_lines,
                               min_chars, held.values.to_numpy().view(np.uint64) if every_copy else None)
                if drop.any():
                    keys.append(key.as_py())
                    texts.append(text.as_py())
                    gone.append(number.values.to_numpy()[drop])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(texts, pa.int64()), pa.array(gone, pa.list_(pa.int32()))],
                ["later", "text_key", "gone"])
    return run


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS, every_copy: bool = False) -> DataFrame:
    """(``doc_id``, ``text_key``, ``lines``): the numbers of the lines that each
    document loses; ``text_key`` is the hash of its text."""
    src = source(docs, id_col, text_col)
    table = stored(src.where("doc_id is not null").mapInArrow(
        _line_table(min_lines, min_chars if every_copy else 0), "doc_id long, text_key long, line array<long>, number array<int>, chars array<int>, run array<long>")
        .where("size(line) > 0"), "lines")
    runs = table.select("doc_id", "text_key", F.explode(F.array_distinct("run")).alias("run"))
    shared = stored(runs.groupBy("run").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
                    .where("owner <> last").select("run", "owner"), "shared-runs")
    pairs = stored(runs.join(shared, "run").where("owner <> doc_id")
                   .select(F.col("doc_id").alias("later"), "text_key", "owner").distinct(), "line-pairs")
    owned = table.select(F.col("doc_id").alias("owner"), F.col("line").alias("owned"), F.col("run").alias("held"))
    aligned = (pairs.join(table.withColumnRenamed("doc_id", "later"), ["later", "text_key"])
               .join(owned, "owner")
               .select("later", "text_key", "line", "number", "chars", "owned", "held")
               .mapInArrow(_align(min_lines, min_chars, every_copy), "later long, text_key long, gone array<int>"))
    return (aligned.groupBy(F.col("later").alias("doc_id"), "text_key")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("lines")))


def _rebuild(names: list[str], text_col: str, lines_col: str, removed_col: str):
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(lo, 512) for x in batches for lo in range(0, x.num_rows, 512)):
            texts, counts = [], []
            for data, lines in zip(b.column(text_col), b.column(lines_col)):
                text = expand(data.as_py())
                text = None if text is None else text.decode()
                if not lines.is_valid:
                    texts.append(text)
                    counts.append(0)
                    continue
                gone = set(lines.as_py())
                texts.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
                counts.append(len(gone))
            cols = [pa.array(texts, pa.string()) if n == text_col else b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], [*names, removed_col])
    return run


def _text_keys(names: list[str], text_col: str, key_col: str):
    """The rows with their texts as compressed bytes, and the texts' hashes."""
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for b in (x.slice(lo, 512) for x in batches for lo in range(0, x.num_rows, 512)):
            keys = [hash_spans(buf, offset[:-1], offset[1:]) for _, _, buf, offset in chunks(b.column(at))]
            cols = list(b.columns)
            cols[at] = pa.array([squeeze(x) for x in cols[at].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(signed(np.concatenate(keys)), pa.int64())],
                                             [*names, key_col])
    return run


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS,
                           removed_col: str | None = None, every_copy: bool = False) -> DataFrame:
    """``docs`` with the common blocks deleted from the later documents;
    ``removed_col`` names an added column with the number of deleted lines (a
    column of that name is replaced); ``every_copy`` deletes repeated and reordered
    copies of a block too.

    "Later" is the larger id.  Null and empty texts, and rows with a null id,
    stay as they are and own nothing.  Rows of one id never lose lines to each
    other and come out as often as they went in.  Lines of white space only are
    not compared and never deleted.  Other columns may have any names."""
    bounded_batches(docs.sparkSession)
    if removed_col in (id_col, text_col):
        raise ValueError(f"{removed_col!r} is the id or the text column")
    if removed_col:
        docs = docs.drop(removed_col)
    names, fields = docs.columns, docs.schema.fields
    removed, key, id_, text, lines = unused(names, removed_col or "removed", "key", "id", "hash", "lines")
    found = stored(repeated_lines(docs, id_col, text_col, min_lines, min_chars, every_copy), "repeated-lines")
    found = found.select(F.col("doc_id").alias(id_), F.col("text_key").alias(text), F.col("lines").alias(lines))
    moved = [StructField(f.name, BinaryType()) if f.name == text_col else f for f in fields]
    keyed = docs.mapInArrow(_text_keys(names, text_col, key), StructType([*moved, StructField(key, LongType())]))
    # sorted and merged at every size: the texts move once, whatever the size of ``found``
    out = (keyed.join(found.hint("merge"), (F.col(id_col).cast("long") == F.col(id_)) & (F.col(key) == F.col(text)), "left")
           .select(*names, lines)
           .mapInArrow(_rebuild(names, text_col, lines, removed), StructType([*fields, StructField(removed, LongType())])))
    return out if removed_col else out.drop(removed)
