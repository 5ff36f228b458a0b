"""Operator 10: quality classifier, a linear support vector machine over n-gram
indicators scaled by naive Bayes log-count ratios.

Features of a text are the hashed distinct byte trigrams, words, word pairs and
runs of one repeated word.  The ratios and the machine are fitted on a bounded
sample of the labelled rows (those of least hash of the id, bounded in rows and
in bytes by documented parameters); the hinge loss is minimised by dual coordinate descent.
Scores are margins through a logistic curve that is fitted to margins of rows
the machine has not seen.  All documents are scored in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import crc32_mod, emit, source, stored
from .words import chunks, mix, split_words

BITS = 18
SAMPLE = 6000            # labels
SAMPLE_BYTES = 64 << 20  # of their features
FOLDS = 5
THRESHOLD = 0.3
_RUNS = (2, 3, 5, 8)


def row_features(buf: np.ndarray, offset: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the distinct features of every row, in order."""
    n = len(offset) - 1
    top = np.uint64(64 - bits)
    parts = []

    def add(row: np.ndarray, value: np.ndarray) -> None:
        parts.append(row.astype(np.uint64) << np.uint64(bits) | mix(value) >> top)

    if len(buf) > 2:
        b = buf.astype(np.uint64)
        value = b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]
        row = np.repeat(np.arange(n), np.diff(offset))
        same = row[:-2] == row[2:]
        add(row[:-2][same], value[same])
    w = split_words(buf, offset)
    h = w.hashes(lower=True)
    add(w.row, h)
    if len(h) > 1:
        pair = w.row[:-1] == w.row[1:]
        add(w.row[:-1][pair], (h[:-1] + mix(h[1:]))[pair])
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & pair
        # length of the run of equal words that ends at each word
        fresh = np.maximum.accumulate(np.where(again, 0, np.arange(len(h))))
        run = np.arange(len(h)) - fresh + 1
        for r in _RUNS:
            hit = np.unique(w.row[run >= r])
            add(hit, np.full(len(hit), 0x5EED00 + r, np.uint64))
    key = np.concatenate(parts)
    key.sort()
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64)


@dataclass
class Model:
    """Score = 1 / (1 + exp(-(slope * margin + shift))); ``ratio`` scales the
    indicators, ``weight`` is the machine's."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        r = self.ratio[feature]
        norm = np.sqrt(np.bincount(row, weights=r * r, minlength=n))
        dot = np.bincount(row, weights=r * self.weight[feature], minlength=n)
        return dot / np.where(norm > 0, norm, 1) + self.bias

    def scores(self, row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(row, feature, n) + self.shift, -40, 40)))


def log_count_ratio(docs: list[np.ndarray], y: np.ndarray, size: int, alpha: float = 1.0) -> np.ndarray:
    p, q = np.full(size, alpha), np.full(size, alpha)
    for x, label in zip(docs, y):
        (p if label else q)[x] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(docs: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0,
                            epochs: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Minimise |w|^2 / 2 + sum of cost * hinge over unit-length rows with a
    constant feature; the rarer class costs as much in all as the other."""
    sign = np.where(y > 0, 1.0, -1.0)
    share = max(float((y > 0).mean()), 1e-9), max(float((y <= 0).mean()), 1e-9)
    limit = cost * np.where(y > 0, 0.5 / share[0], 0.5 / share[1])
    values = []
    for x in docs:
        v = ratio[x]
        norm = np.sqrt(v @ v)
        values.append(v / norm if norm > 0 else v)
    square = np.array([v @ v + 1 for v in values])
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(docs))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(docs)):
            x, v = docs[i], values[i]
            g = sign[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - g / square[i], 0.0), limit[i])
            d = (new - alpha[i]) * sign[i]
            if d:
                w[x] += d * v
                bias += d
                most = max(most, abs(d))
                alpha[i] = new
        if most < 1e-4:
            break
    return w, bias


def _curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and shift by Newton steps, with smoothed targets."""
    up, down = float((y > 0).sum()), float((y <= 0).sum())
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, float(np.log((up + 1) / (down + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        s = np.maximum(p * (1 - p), 1e-9)
        ga, gb = ((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()
        haa, hab, hbb = (s * margin * margin).sum() + 1e-3, (s * margin).sum(), s.sum() + 1e-9
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - np.clip(da, -5, 5), b - np.clip(db, -5, 5)
        if abs(da) + abs(db) < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)


def fit(docs: list[np.ndarray], y: np.ndarray, bits: int = BITS) -> Model:
    """With one class or no rows: a constant score, the smoothed class share."""
    size = 1 << bits
    if len(docs) < 4 or len(np.unique(y)) < 2:
        up = float((y > 0).sum())
        return Model(np.zeros(size), np.zeros(size), 0.0, 1.0, float(np.log((up + 1) / (len(docs) - up + 1))))
    half = np.arange(len(docs)) % 2 == 0
    margin = np.zeros(len(docs))
    for part in (half, ~half):
        inside = np.flatnonzero(part)
        if len(np.unique(y[inside])) < 2:
            continue
        some = [docs[i] for i in inside]
        ratio = log_count_ratio(some, y[inside], size)
        w, bias = dual_coordinate_descent(some, y[inside], ratio)
        half_model = Model(ratio, w, bias, 1.0, 0.0)
        for i in np.flatnonzero(~part):
            margin[i] = half_model.margins(np.zeros(len(docs[i]), np.int64), docs[i], 1)[0]
    ratio = log_count_ratio(docs, y, size)
    w, bias = dual_coordinate_descent(docs, y, ratio)
    return Model(ratio, w, bias, *_curve(margin, y))


def _features(bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offset in chunks(b.column(2)):
                row, feature = row_features(buf, offset, bits)
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                feature = feature.astype(np.uint32)
                yield from emit(["id", "y", "x"], [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                                                   pa.array([feature[cut[i]:cut[i + 1]].tobytes() for i in range(hi - lo)],
                                                            pa.binary())], rows=1024)
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE, bits: int = BITS,
          sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on labelled rows outside the held-out fold: in the order of a hash of the
    id, at most ``sample`` labels, and of those as many whole rows as have features
    of ``sample_bytes`` bytes together (four a feature), so that what the driver
    fits is bounded however long texts are.  Of several rows of one id the least
    text counts."""
    some = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
            .where(crc32_mod(F.col("id"), FOLDS) != 0)
            .orderBy(F.xxhash64("id"), "id", "y").limit(sample))
    rows = stored(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
                  .join(F.broadcast(some), "id")                # at most ``sample`` rows of two numbers
                  .groupBy("id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
                  .select("id", "y", "text").mapInArrow(_features(bits), "id long, y int, x binary"), "svm-sample")
    rows = rows.withColumn("at", F.xxhash64("id"))
    sizes = rows.select("at", "id", "y", F.length("x").alias("size")).collect()         # at most ``sample`` rows
    held, last = 0, None
    for r in sorted(sizes, key=lambda r: (r["at"], r.id, r.y)):
        held += r.size
        if held > sample_bytes:
            break
        last = r["at"]
    rows = rows.where(F.col("at") <= F.lit(last)).collect() if last is not None else []
    order = sorted(range(len(rows)), key=lambda i: (bytes(rows[i].x), rows[i].y))
    x = [np.frombuffer(rows[i].x, np.uint32).astype(np.int64) for i in order]
    return fit(x, np.array([rows[i].y for i in order], np.int64), bits)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
           bits: int = BITS) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    Null and empty texts have no features and get the score of the bias alone.
    A null id is not held out.  Repeated rows come out as often as they went in,
    an empty table gives no rows, other columns are not looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # two arrays of 2**bits numbers

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offset in chunks(b.column(1)):
                row, feature = row_features(buf, offset, bits)
                yield from emit(["doc_id", "score"], [b.column(0).slice(lo, hi - lo),
                                                      shared.value.scores(row, feature, hi - lo)])

    src = source(docs, id_col, text_col)
    return src.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(crc32_mod(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
