"""Scalar function helpers shared by the library and the catalogue."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(col, digits: int = 2) -> Column:
    """Round half-up at ``digits`` decimals as floor(x·10^d + 0.5)/10^d.

    Unlike ``round`` (decimal-string based in Spark, binary in other
    engines) this rounds the same binary double the same way everywhere,
    so reports agree across engines."""
    c = F.col(col) if isinstance(col, str) else col
    s = float(10 ** digits)
    return F.floor(c * F.lit(s) + F.lit(0.5)) / F.lit(s)


def fixed_sql(expr: str, digits: int = 2) -> str:
    s = 10 ** digits
    return f"(floor(({expr}) * {s} + 0.5) / {s})"


def hashed_number(*cols: Column | str) -> Column:
    """A number below 2**32 from the text of some columns (the head of their MD5),
    the same in every engine: draws that SQL can repeat."""
    text = F.concat_ws(":", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
