"""Array / vector helpers as native higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Σ a_i · b_i."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def squared_distance(a, b) -> Column:
    """Σ (a_i − b_i)²."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, v: acc + v)


def one_hot_index(arr) -> Column:
    """0-based position of the 1.0 in a one-hot array (−1 if none)."""
    return F.array_position(_c(arr), 1.0) - 1
