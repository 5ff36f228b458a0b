"""Date and time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_month_name_date(s, fmt: str = "dd-MMM-yyyy") -> Column:
    """H17: '28-Sep-2023' / '28-SEP-2023' → date, no UDF; NULL when
    unparsable (``try_to_timestamp``; ANSI ``to_timestamp`` would raise)."""
    return F.to_date(F.try_to_timestamp(_c(s), F.lit(fmt)))


def parse_log_time(s) -> Column:
    """Common Log Format time, zone ignored."""
    return F.try_to_timestamp(F.substring(_c(s), 1, 20), F.lit("dd/MMM/yyyy:HH:mm:ss"))


def is_valid_date(y, m, d) -> Column:
    """Strict calendar validity of (year, month, day) — e.g. 30
    February is invalid."""
    txt = F.format_string("%04d-%02d-%02d", _c(y), _c(m), _c(d))
    return F.try_to_timestamp(txt, F.lit("yyyy-MM-dd")).isNotNull()


def partition_values_from_path(path_col, pattern: str = r"year=(\d+)/month=(\d+)/day=(\d+)") -> list[Column]:
    """(year, month, day) from a partition path (e.g. input_file_name())."""
    p = _c(path_col)
    return [F.regexp_extract(p, pattern, i).try_cast("int") for i in (1, 2, 3)]


def date_from_bhav_name(name_col) -> Column:
    """H16: 'foDDMONYYYYbhav...' file name → date."""
    n = _c(name_col)
    return parse_month_name_date(
        F.concat_ws("-", F.substring(n, 3, 2), F.substring(n, 5, 3), F.substring(n, 8, 4)))
