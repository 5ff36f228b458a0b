"""Window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def monthly_grain(df: DataFrame, key: str, ts: str, aggs: dict[str, Column]) -> DataFrame:
    """Aggregate to a unique (key, month) grain — the total order windows
    need.  ``month`` is a 'yyyy-MM' string."""
    month = F.date_format(F.date_trunc("month", F.col(ts)), "yyyy-MM").alias("month")
    return df.groupBy(key, month).agg(*[e.alias(n) for n, e in aggs.items()])


def running_sum(value, keys: list[str], order, frame: str = "range") -> Column:
    """Running sum.  ``range`` is SQL's default frame (peers with equal
    order values share a total); ``rows`` counts row by row."""
    w = Window.partitionBy(*keys).orderBy(_c(order))
    w = (w.rangeBetween(Window.unboundedPreceding, Window.currentRow) if frame == "range"
         else w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum(_c(value)).over(w)


def moving_avg(value, keys: list[str], order, preceding: int) -> Column:
    """``ROWS n PRECEDING`` moving average (n + 1 rows with current)."""
    w = Window.partitionBy(*keys).orderBy(_c(order)).rowsBetween(-preceding, Window.currentRow)
    return F.avg(_c(value)).over(w)


def row_number_per(keys: list[str], *order) -> Column:
    """Row number per partition."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
