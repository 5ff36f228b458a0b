"""Operator 4: Jaccard self-join of documents on word shingles, with adaptive
multi-match prefixes.

Two sets of sizes n <= m with ``100 * |both| >= t * |either|`` share at least
``t * (n + m) / (100 + t)`` shingles.  If every set is written in one global
order (rarest shingle first), then the first ``size - overlap + l`` shingles of
both share at least ``l`` of them, for any ``l``.  Each document chooses its own
``l`` from the document frequencies of its prefix: a longer prefix visits more
postings, but a partner then needs ``l`` hits before it is verified.  A pair is
judged by the ``l`` of its larger document (the probe); the smaller one is found
through its shorter index prefix.

Steps, all as Spark jobs:

1. Equal sets become one node (``sid``, a 64-bit fingerprint of the set).
2. Of every set, the shingles in the lowest share of the hash space are counted.
   A set with more than ``n - overlap`` shingles of its own has no partner, so
   most documents leave here, before their shingles are ever sorted.
3. The sets of the others are fetched once; all their shingles get their document
   frequency among them (exact, but for the few that very many sets have: those are
   found first, and no task gathers their rows); prefixes and ``l`` are chosen.
4. Per prefix shingle, every set is verified against the earliest document that
   has it.  In a group of copies this joins nearly all of them to the original
   in linear work.  The links' components follow.
5. The remaining pairs, of different components only, are joined by the prefixes
   that their two sizes need, with frequency and position filters, counted against ``l`` and verified.
   So links inside a component that is known already are not written out, and no
   link between different components is lost.

Shingles are 64-bit hashes; the check on a pair intersects the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .tables import emit, gathered, group_starts, source, stored, tidy, width
from .texts import expand, packed, unpacked
from .words import chunks, document_sets, mix, signed, split_words

LOW_SHARE = 0.3
_LOW = np.uint64(int(LOW_SHARE * 2 ** 64))
MAX_MATCHES = 3
VERIFY_WEIGHT = 8.0       # postings visited in the time of one verification
_LOCAL = 64               # sets of one task with a shingle that then counts as shared
_HELD = 1 << 21           # shingles that a task holds before it counts them
_HOT = 20_000             # sets with a shingle that is then not counted in one task


def _sets(column: pa.Array, k: int):
    """Per chunk of rows: first row, sizes, fingerprints, bounds, shingles."""
    for lo, hi, buf, offset in chunks(column):
        row, value = document_sets(split_words(buf, offset), k)
        bound = np.searchsorted(row, np.arange(hi - lo + 1))
        size = np.diff(bound)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value))))
        sid = mix((total[bound[1:]] - total[bound[:-1]]) + size.astype(np.uint64))
        yield lo, hi, row, size, sid, bound, value


def _stats(k: int):
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, row, size, sid, bound, value in _sets(b.column(1), k):
                low = np.bincount(row[value < _LOW], minlength=hi - lo)
                yield from emit(["doc_id", "n", "low", "sid"],
                                [b.column(0).slice(lo, hi - lo), size.astype(np.int64),
                                 low.astype(np.int64), signed(sid)])
    return run


def _low_tokens(k: int):
    """(token, sid, credit): the low shingles of the distinct sets of a task.  Of a
    shingle that ``_LOCAL`` sets of the task have, it is known here that sets share
    it: each set's number of those is shipped as its credit, and one row of the
    shingle (credit -1) tells the other tasks.  So a shingle in any share of the
    texts is a few rows per task."""
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            token, sid = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(token, kind="stable")
            token, sid = token[order], sid[order]
            head = np.flatnonzero(group_starts(token))
            count = np.diff(np.append(head, len(token)))
            many = np.repeat(count >= _LOCAL, count)
            yield from emit(["token", "sid", "credit"], [token[~many], sid[~many], np.zeros(int((~many).sum()), np.int64)])
            if many.any():
                at = head[count >= _LOCAL]
                yield from emit(["token", "sid", "credit"], [token[at], sid[at], np.full(len(at), -1)])
                own, credit = np.unique(sid[many], return_counts=True)
                yield from emit(["token", "sid", "credit"], [own, own, credit.astype(np.int64)])

        for b in batches:
            for lo, hi, row, set_size, sid, bound, value in _sets(b.column(0), k):
                new = np.zeros(hi - lo, bool)
                for i, s in enumerate(sid.tolist()):
                    if set_size[i] and s not in seen:
                        seen.add(s)
                        new[i] = True
                keep = new[row] & (value < _LOW)
                held.append(((value[keep] >> np.uint64(16)).view(np.int64), signed(sid)[row[keep]]))
                size += len(held[-1][0])
                if size >= _HELD:
                    yield from rows()
                    held, size = [], 0
        if size:
            yield from rows()
    return run


@tidy
def _count_shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sid, shared): how many of a set's low shingles other sets have too, at
    least; a partition holds all rows of its shingles."""
    token, sid, credit = gathered(batches, ["token", "sid", "credit"])
    known = credit > 0
    yield from emit(["sid", "shared"], [sid[known], credit[known]])
    token, sid, told = token[~known], sid[~known], credit[~known] < 0
    order = np.lexsort((~told, sid, token))              # of equal rows, one that was credited already
    token, sid, told = token[order], sid[order], told[order]
    first = group_starts(token, sid)
    token, sid, told = token[first], sid[first], told[first]
    head = np.flatnonzero(group_starts(token))
    count = np.diff(np.append(head, len(token)))
    if not len(head):
        return
    shared = np.repeat((count > 1) | np.logical_or.reduceat(told, head), count)
    ids, n = np.unique(sid[shared & ~told], return_counts=True)
    yield from emit(["sid", "shared"], [ids, n.astype(np.int64)])


def _frequent_tokens(total: int, least: int):
    """(token, c): shingles that are frequent among those that a task holds."""
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            token, c = np.unique(np.concatenate(held), return_counts=True)
            some = c >= max(2, least * size // (4 * total))
            yield from emit(["token", "c"], [token[some], c[some].astype(np.int64)])

        for b in batches:
            held += [np.frombuffer(x.as_py(), np.int64) for x in b.column(0)]
            size = sum(map(len, held))
            if size >= _HELD:
                yield from rows()
                held, size = [], 0
        if size:
            yield from rows()
    return run


def _hot_tokens(sets: DataFrame, total: int, least: int | None = None) -> dict[int, int]:
    """Shingles that about ``least`` sets have, or more, with about their number:
    at most four in three of ``total / least``.  ``least`` is ``_HOT``, or a
    100,000th of all shingles where that is more, so their table has a fixed bound.

    A task reports the shingles whose share of what it holds is a quarter of that;
    what no task reports of a shingle adds up to a quarter, so every shingle of
    ``least`` sets is found."""
    least = least or max(_HOT, total // 100_000)
    if total < least:
        return {}
    rows = (sets.select("tokens").mapInArrow(_frequent_tokens(total, least), "token long, c long")
            .groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") >= least * 3 // 4).collect())
    return {r.token: r.c for r in rows}


def _frequencies(hot: dict[int, int]):
    """(sid, token, df) of shingles that several sets have; a partition holds all
    rows of its shingles, but for hot ones, whose number is known."""
    tokens = np.array(sorted(hot), np.int64)
    counts = np.array([hot[t] for t in tokens.tolist()], np.int64)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, sid = gathered(batches, ["token", "sid"])
        if len(tokens):
            at = np.minimum(np.searchsorted(tokens, token), len(tokens) - 1)
            known = tokens[at] == token
            yield from emit(["sid", "token", "df"], [sid[known], token[known], counts[at[known]]])
            token, sid = token[~known], sid[~known]
        order = np.lexsort((sid, token))
        token, sid = token[order], sid[order]
        first = group_starts(token, sid)
        token, sid = token[first], sid[first]
        head = np.flatnonzero(group_starts(token))
        count = np.diff(np.append(head, len(token)))
        df = np.repeat(count, count)
        m = df > 1
        yield from emit(["sid", "token", "df"], [sid[m], token[m], df[m].astype(np.int64)])
    return run


def _whole_sets(k: int):
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                texts = pa.array([expand(x) for x in b.column(1).to_pylist()], pa.binary()).cast(pa.string())
                for lo, hi, row, size, sid, bound, value in _sets(texts, k):
                    tokens = [value[bound[i]:bound[i + 1]].tobytes() for i in range(hi - lo)]
                    yield from emit(["sid", "first", "n", "tokens"],
                                    [signed(sid), b.column(0).slice(lo, hi - lo), size.astype(np.int64),
                                     pa.array(tokens, pa.binary())], rows=2048)
    return run


def _explode(hot: dict[int, int]):
    """(token, sid) of all sets; with hot shingles also ``deal``, by which rows go
    to tasks: the shingle, but for a hot one the set."""
    tokens = np.array(sorted(hot), np.int64)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sid = b.column("sid").to_numpy(zero_copy_only=False)
            parts = [np.frombuffer(x.as_py(), np.int64) for x in b.column("tokens")]
            if parts:
                token, own = np.concatenate(parts), np.repeat(sid, [len(p) for p in parts])
                if not len(tokens):
                    yield from emit(["token", "sid"], [token, own])
                    continue
                at = np.minimum(np.searchsorted(tokens, token), len(tokens) - 1)
                yield from emit(["token", "sid", "deal"], [token, own, np.where(tokens[at] == token, own, token)])
    return run


def overlap(n, percent: int):
    """Least overlap of a set of size ``n`` with any partner."""
    return -(-percent * n // 100)


def index_overlap(n, percent: int):
    """Least overlap of a set of size ``n`` with a partner not smaller."""
    return -(-2 * percent * n // (100 + percent))


def choose_matches(df: np.ndarray, base: int) -> int:
    """The number of hits with the least estimated cost: postings visited, and
    partners to verify.  Copies share most of a prefix, so about as many sets
    have ``hits`` hits as have the ``hits``-th most frequent shingle of it: more
    hits pay where a few shingles are far more frequent than the others.
    ``df``: frequencies of the shared shingles in prefix order; ``base``: how
    many of them a one-hit prefix has."""
    best, least = 1, float("inf")
    for hits in range(1, MAX_MATCHES + 1):
        part = df[:base + hits - 1]
        if len(part) < hits:
            break
        cost = float(part.sum()) + VERIFY_WEIGHT * float(part[-hits])   # df ascends
        if cost < least:
            best, least = hits, cost
    return best


def _prefixes(percent: int):
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(9)]
            rows = zip(b.column("sid").to_pylist(), b.column("first").to_pylist(),
                       b.column("n").to_pylist(), b.column("shared"))
            for sid, first, n, shared in rows:
                items = shared.values
                df = items.field(0).to_numpy()
                token = items.field(1).to_numpy()
                c = len(df)
                spare = n - overlap(n, percent)          # prefix places before the one-hit place
                own = n - c                              # shingles of no other set come first
                if own > spare:
                    continue
                order = np.lexsort((token, df))
                df, token = df[order], token[order]
                base = spare + 1 - own
                hits = choose_matches(df, base)
                place = np.arange(c) + own
                level = np.maximum(1, place - (n - index_overlap(n, percent)) + 1)
                probe = place < spare + hits
                keep = np.flatnonzero(probe | (level <= MAX_MATCHES))
                for o, x in zip(out, (token, None, None, None, None, place, None, level, probe)):
                    if x is not None:
                        o.append(x[keep])
                m = len(keep)
                for i, x in ((1, sid), (2, -1 if first is None else first), (3, n), (4, c), (6, hits)):
                    out[i].append(np.full(m, x, np.int64))
            if out[0]:
                yield from emit(["token", "sid", "first", "n", "c", "place", "hits", "level", "probe"],
                                [np.concatenate(o) for o in out])
    return run


_PREFIX_SCHEMA = ("token long, sid long, first long, n long, c long, place long, hits long, "
                  "level long, probe boolean")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose whole sets are similar enough."""
    left = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("y"))

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column("x"), b.column("y"))):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok[i] = 100 * both >= percent * (len(p) + len(q) - both)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])

    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = 5, percent: int = 80, hot_sets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and
    ``component_id``, the smallest id reachable over links.

    Null or empty text, or text without words: zero shingles, linked with
    nothing.  Fewer than ``k`` words: the whole sequence is the one shingle.
    Repeated rows come out as often as they went in.  Rows of one id and
    different texts are different documents; a null id is never the smallest of
    a group, and alone has a null component.  Other columns are not looked at.
    ``hot_sets`` overrides from how many sets on a shingle counts as hot; the
    result is the same.
    """
    spark = docs.sparkSession
    src = source(docs, id_col, text_col)
    stats = stored(src.mapInArrow(_stats(k), "doc_id long, n long, low long, sid long"), "shingle-stats")
    classes = stored(stats.where("n > 0").groupBy("sid").agg(
        F.min("doc_id").alias("first"), F.min("n").alias("n"), F.min("low").alias("low")), "shingle-classes")
    low, = classes.agg(F.sum("low")).first()
    shared = (src.select("text").mapInArrow(_low_tokens(k), "token long, sid long, credit long")
              .repartition(width(spark, low or 0), "token")
              .mapInArrow(_count_shared, "sid long, shared long")
              .groupBy("sid").agg(F.sum("shared").alias("shared")))
    spare = F.expr(f"n - ceil({percent} * n / 100)")
    able = stored(classes.join(shared, "sid", "left")
                  .where(F.col("low") - F.coalesce("shared", F.lit(0)) <= spare)
                  .select("sid", "first", "n"), "shingle-able")
    size, = able.agg(F.sum("n")).first()

    # a class whose rows all lack an id is found by its text, through the null-safe join
    wanted = able.select(F.col("first").alias("__first")).distinct()
    texts = packed(src, "text")
    # sorted and merged at every size: packing and reading then stand in different tasks, one worker each
    sets = stored(texts.join(wanted.hint("merge"), texts.doc_id.eqNullSafe(F.col("__first")), "left_semi")
                  .select("doc_id", "text")
                  .mapInArrow(_whole_sets(k), "sid long, first long, n long, tokens binary")
                  .join(able.select("sid"), "sid", "left_semi")
                  .groupBy("sid").agg(F.min("first").alias("first"), F.min("n").alias("n"),
                                      F.first("tokens").alias("tokens")), "shingle-sets")
    hot = _hot_tokens(sets, size or 0, hot_sets)
    freq = (sets.select("sid", "tokens").mapInArrow(_explode(hot), "token long, sid long" + ", deal long" * bool(hot))
            .repartition(width(spark, size or 0), "deal" if hot else "token").select("token", "sid")
            .mapInArrow(_frequencies(hot), "sid long, token long, df long")
            .groupBy("sid").agg(F.collect_list(F.struct("df", "token")).alias("shared")))
    prefix = stored(freq.join(sets.select("sid", "first", "n"), "sid")
                    .select("sid", "first", "n", "shared")
                    .mapInArrow(_prefixes(percent), _PREFIX_SCHEMA), "shingle-prefixes")

    def fits(r: str, s: str) -> str:
        return (f"100 * least({r}.n, {s}.n) >= {percent} * greatest({r}.n, {s}.n) and "
                f"{100 + percent} * least({r}.c, {s}.c) >= {percent} * ({r}.n + {s}.n)")

    lead = stored(prefix.groupBy("token").agg(F.min(F.struct("first", "sid", "n", "c")).alias("l"),
                                              F.count("*").alias("k"))
                  .where("k > 1").select("token", F.col("l.sid").alias("sid"), F.col("l.n").alias("n"),
                                         F.col("l.c").alias("c")), "shingle-leaders")
    star = (prefix.alias("s").join(lead.alias("l"), "token")
            .where(F.expr(f"s.sid <> l.sid and {fits('l', 's')}"))
            .select(F.col("l.sid").alias("a"), F.col("s.sid").alias("b")).distinct())
    links = stored(_verified(star, sets, percent), "shingle-links")
    comp = stored(connected(links, "a", "b"), "shingle-components")

    posted = prefix.join(comp.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "component", F.coalesce("component", "sid"))
    open_ = posted.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rest = stored(posted.join(open_.select("token"), "token", "left_semi"), "shingle-postings")
    r, s = rest.where("probe").alias("r"), rest.where(F.col("level") <= MAX_MATCHES).alias("s")
    reach = "least(r.place - r.n + r.c, s.place - s.n + s.c) + 1 + least(r.n - 1 - r.place, s.n - 1 - s.place)"
    # the pair's own prefixes are shorter than those for any partner
    need = f"ceil({percent} * (r.n + s.n) / {100 + percent})"
    early = f"r.place < r.n - {need} + r.hits and s.place < s.n - {need} + r.hits"
    pairs = (r.join(s, F.expr("r.token = s.token and r.component <> s.component and s.level <= r.hits and "
                              f"(r.n > s.n or r.n = s.n and r.sid > s.sid) and {early} and "
                              f"{fits('r', 's')} and {100 + percent} * ({reach}) >= {percent} * (r.n + s.n)"))
             .groupBy(F.col("r.sid").alias("a"), F.col("s.sid").alias("b"), F.col("r.hits").alias("hits"))
             .count().where("count >= hits").select("a", "b"))
    more = _verified(pairs, sets, percent)
    named = comp.select(F.col("node"), "component")

    def comp_of(df: DataFrame, c: str) -> DataFrame:
        return (df.join(named.select(F.col("node").alias(c), F.col("component").alias("__c")), c, "left")
                .withColumn(c, F.coalesce("__c", c)).drop("__c"))

    joined = stored(connected(comp_of(comp_of(more, "a"), "b"), "a", "b"), "shingle-joined")
    whole = (classes.select("sid", "first")
             .join(comp.withColumnRenamed("node", "sid"), "sid", "left")
             .withColumn("c1", F.coalesce("component", "sid")).drop("component")
             .join(joined.withColumnRenamed("node", "c1"), "c1", "left")
             .withColumn("c", F.coalesce("component", "c1")).select("sid", "first", "c"))
    least = whole.groupBy("c").agg(F.min("first").alias("component_id"))
    label = stored(whole.join(least, "c").select("sid", "component_id"), "shingle-labels")
    out = stats.join(label, "sid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
               percent: int = 80) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id's.

    Rows with a null id stay.  Of repeated rows of one id, one stays."""
    found = near_duplicates(docs, id_col, text_col, k, percent)
    keep = found.where("component_id = doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    cols = docs.columns
    some = packed(docs.where(F.col(id_col).isNotNull()), text_col)
    some = some.join(keep, id_col, "left_semi").dropDuplicates([id_col])
    return unpacked(some, text_col).select(*cols).unionByName(docs.where(F.col(id_col).isNull()))
