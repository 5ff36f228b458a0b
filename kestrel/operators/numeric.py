"""Numeric set operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT = 1 << 20        # numbers that a task sieves at once


def _small_primes(upto: int) -> np.ndarray:
    flags = np.ones(upto + 1, bool)
    flags[:2] = False
    for p in range(2, int(upto ** 0.5) + 1):
        if flags[p]:
            flags[p * p::p] = False
    return np.flatnonzero(flags)


def primes_upto(spark: SparkSession, highest: int, segment: int = SEGMENT) -> DataFrame:
    """(n): the primes up to ``highest``, by a segmented sieve.

    The range is cut into segments, dealt over the tasks; a task sieves each of
    its segments in numpy by the primes up to the root of the segment's end, which
    it finds itself, so nothing is broadcast and its memory is one segment and
    that root."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = np.zeros(0, np.int64)
        for b in batches:
            for k in b.column(0).to_pylist():
                lo, hi = k * segment, min((k + 1) * segment, highest + 1)
                root = int(hi ** 0.5) + 1
                if not len(small) or small[-1] < root:
                    small = _small_primes(2 * root)
                flags = np.ones(hi - lo, bool)
                flags[:max(0, 2 - lo)] = False
                for p in small[small * small < hi].tolist():
                    flags[max(p * p, -(-lo // p) * p) - lo::p] = False
                yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(flags) + lo)], ["n"])

    segments = spark.range(0, max(0, highest) // segment + 1)
    return segments.repartition("id").mapInArrow(run, "n long")


def prime_flags(df: DataFrame, col: str, segment: int = SEGMENT) -> DataFrame:
    """``df`` with ``is_prime``, by a join with the primes up to the largest value.
    Null and values below 2 are no primes; an empty table stays empty."""
    highest = df.agg(F.max(col)).first()[0]
    primes = primes_upto(df.sparkSession, int(highest or 0), segment).withColumn("is_prime", F.lit(True))
    out = df.join(primes, F.col(col) == F.col("n"), "left") if col != "n" else df.join(primes, "n", "left")
    return out.select(*df.columns, F.coalesce("is_prime", F.lit(False)).alias("is_prime"))
