"""Texts as compressed bytes while they move through a shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .tables import tidy

_ROWS = 512


def squeeze(text: str | None) -> bytes | None:
    """Eight bytes of length, then the zstd frame; null stays null."""
    if text is None:
        return None
    raw = text.encode()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def expand(data: bytes | None) -> bytes | None:
    if data is None:
        return None
    return pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _mapped(df: DataFrame, col: str, kind, change, arrow: pa.DataType) -> DataFrame:
    fields = [StructField(f.name, kind if f.name == col else f.dataType) for f in df.schema.fields]
    at = df.columns.index(col)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, _ROWS):
                part = b.slice(lo, _ROWS)
                cols = list(part.columns)
                cols[at] = pa.array([change(x) for x in cols[at].to_pylist()], arrow)
                yield pa.RecordBatch.from_arrays(cols, part.schema.names)

    return df.mapInArrow(run, StructType(fields))


def packed(df: DataFrame, col: str) -> DataFrame:
    """``df`` with the string column ``col`` as compressed bytes."""
    return _mapped(df, col, BinaryType(), squeeze, pa.binary())


def unpacked(df: DataFrame, col: str) -> DataFrame:
    return _mapped(df, col, StringType(), lambda x: None if x is None else expand(x).decode(), pa.string())
