"""Written intermediate tables and small shared helpers of the subpackage."""

from __future__ import annotations

import ctypes
import functools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ROWS_OUT = 1 << 17


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    runs the work once, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Where the session has Spark's own batch limit of 64 MB, hand texts to the
    Python workers in batches of 8 MB: several copies of a batch live at once."""
    if spark.conf.get(_BATCH_BYTES).lower() in ("64mb", "67108864", "67108864b"):
        spark.conf.set(_BATCH_BYTES, "8m")


def tidy(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that hands free memory back to the system
    when its partition ends: the Python worker lives on, idle or not, beside the
    workers of other stages."""

    @functools.wraps(run)
    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # of glibc
            if trim:
                trim(0)

    return whole


def unused(names: list[str], *wanted: str) -> list[str]:
    """The wanted column names, each with as many underscores more as it needs
    to differ from ``names`` (in any case of letters)."""
    taken, out = {n.lower() for n in names}, []
    for w in wanted:
        while w.lower() in taken:
            w += "_"
        taken.add(w.lower())
        out.append(w)
    return out


def source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns that an operator reads, under fixed names and types."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def width(spark: SparkSession, rows: float, per_task: int = 1 << 20) -> int:
    """Partitions so that a task gets about ``per_task`` rows at most, and no
    fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_task))


def crc32_mod(col: Column, n: int) -> Column:
    return F.crc32(col.cast("string").cast("binary")) % n


def emit(names: list[str], columns: list, types: list[pa.DataType] | None = None,
         rows: int = ROWS_OUT) -> Iterator[pa.RecordBatch]:
    """Yield equal-length columns as record batches of bounded size."""
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, t)
              for c, t in zip(columns, types or [None] * len(columns))]
    n = len(arrays[0])
    table = pa.table(dict(zip(names, arrays)))
    for lo in range(0, n, rows):
        yield from table.slice(lo, rows).combine_chunks().to_batches()


def gathered(batches: Iterable[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    """All rows of a partition as numpy columns."""
    parts: list[list[np.ndarray]] = [[] for _ in names]
    for b in batches:
        for p, n in zip(parts, names):
            p.append(b.column(n).to_numpy(zero_copy_only=False))
    return [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]


def group_starts(*keys: np.ndarray) -> np.ndarray:
    """Mask of the rows that begin a new group in sorted key columns."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return new
