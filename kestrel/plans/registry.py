"""Query catalogue registry.

Each catalogue entry is a named Spark query over the driver tables (all
rows of the tables it reads) plus, where the semantics are SQL-expressible,
an equivalent DuckDB query used as the correctness oracle.  ``ids`` lists
the SURVEY §2 operator IDs the entry exercises.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    ids: tuple[str, ...]
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    note: str = ""
    tags: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None, note: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, tuple(i.strip() for i in ids.split(",") if i.strip()), fn,
                               sql.strip() if sql else None, note)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    """Import every catalogue module (registration is a side effect)."""
    from . import (relational, aggregates, windows, scalars, markets, weblogs,  # noqa: F401
                   textjobs, citystate, streams, tables, udfs, mljobs)
    return REGISTRY
