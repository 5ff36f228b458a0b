"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    return (e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, component) for every node that has an edge; the component is
    its smallest node.  The number of rounds grows with the logarithm of the
    largest diameter; every round is written to the shared folder."""
    cur = stored(edges.where(F.col(a) != F.col(b))
                 .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(cur)
    while before[0]:
        cur = stored(_small_star(_large_star(cur)), "edges")
        after = mark(cur)
        if after == before:
            break
        before = after
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
