"""Sparse vectors of records in numpy over Arrow columns: shares of tokens, and
products with an index of the other side."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CELLS = 1 << 19         # sums held at once, or those of one record


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 and flat values of a list column; a null is an empty list."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(size, dtype=np.int64))), column.flatten()


def token_shares(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, tokens, counts): the distinct tokens of every row, how often each
    occurs and the number of all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            offset, flat = _lists(b.column(len(keys)))
            coded = flat.dictionary_encode()
            row = np.repeat(np.arange(b.num_rows), np.diff(offset))
            width = max(1, len(coded.dictionary))
            cell, count = np.unique(row * width + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            at = pa.array(np.searchsorted(cell // width, np.arange(b.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keys)], pa.array(np.diff(offset)),
                 pa.ListArray.from_arrays(at, coded.dictionary.take(pa.array(cell % width))),
                 pa.ListArray.from_arrays(at, pa.array(count.astype(np.int64)))], [*keys, "n", "tokens", "counts"])

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, "tokens").mapInArrow(run, f"{kinds}, n long, tokens array<string>, counts array<long>")


def products(df: DataFrame, a_id: str, b_id: str, kind_b: str, block) -> DataFrame:
    """(a_id, b_id, sim): per row (id, tokens, shares, norm) the sum of share times
    weight over the tokens of every record of ``block`` (a pandas frame b_id, token,
    weight), by the norm; records without a common token have no row."""
    block = block.sort_values("token", kind="stable")
    tokens, first, many = np.unique(block["token"].to_numpy(object), return_index=True, return_counts=True)
    ids, item = np.unique(block[b_id].to_numpy(), return_inverse=True)
    sent = df.sparkSession.sparkContext.broadcast((list(tokens), first, many, ids, item, block["weight"].to_numpy(float)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, first, many, ids, item, weight = sent.value
        known, step = pa.array(tokens, pa.string()), max(1, _CELLS // len(ids))
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                b = whole.slice(lo, step)
                offset, flat = _lists(b.column(1))
                code = pc.fill_null(pc.index_in(flat, known), -1).to_numpy(zero_copy_only=False)
                hit = np.flatnonzero(code >= 0)
                row, code = np.repeat(np.arange(b.num_rows), np.diff(offset))[hit], code[hit]
                share = _lists(b.column(2))[1].to_numpy(zero_copy_only=False)[hit]
                n = many[code]
                posting = np.repeat(first[code] - np.cumsum(n) + n, n) + np.arange(n.sum())
                cell = np.repeat(row * len(ids), n) + item[posting]
                total = np.bincount(cell, np.repeat(share, n) * weight[posting], b.num_rows * len(ids))
                cell = np.flatnonzero(total)
                row = cell // len(ids)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(ids[cell % len(ids)]),
                     pa.array(total[cell] / b.column(3).to_numpy(zero_copy_only=False)[row])], [a_id, b_id, "sim"])

    src = df.select(F.col("id").alias("id"), "tokens", "shares", "norm")
    return src.mapInArrow(run, f"`{a_id}` {df.schema['id'].dataType.simpleString()}, `{b_id}` {kind_b}, sim double")
