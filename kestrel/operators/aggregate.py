"""Aggregation operators.

Everything is expressed with built-in aggregate functions so Spark plans a
partial (map-side) aggregate before the shuffle; a hot key therefore costs
one partial row per input partition, not its whole group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import placed_by_range


def stats(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, population stddev, max, min in one pass."""
    c = F.col(col)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"),
                  F.stddev_pop(c).alias("stdev"), F.max(c).alias("max"), F.min(c).alias("min"))


def sum_count(df: DataFrame, col: str, keys: list[str] | None = None) -> DataFrame:
    """(sum, count) per key — ``aggregate`` / ``combineByKey`` /
    ``aggregateByKey`` with the usual (sum, count) combiner."""
    g = df.groupBy(*keys) if keys else df
    return g.agg(F.sum(col).alias("total"), F.count(F.lit(1)).alias("n"))


def tree_aggregate(df: DataFrame, col: str, fanin: int = 8) -> DataFrame:
    """Two-level aggregate — partial sums per group of input partitions,
    then a global sum over the (few) partials."""
    part = (df.withColumn("__g", F.pmod(F.spark_partition_id(), F.lit(fanin)))
              .groupBy("__g").agg(F.sum(col).alias("__s"), F.count(F.lit(1)).alias("__n")))
    return part.agg(F.sum("__s").alias("total"), F.sum("__n").alias("n"))


def group_to_lists(df: DataFrame, key, value: str, sort: bool = True) -> DataFrame:
    """``groupBy(f)`` / ``groupByKey`` to value lists.

    Note: a list per key is inherently the size of its group; use only for
    bounded groups (display, small dimensions).  For anything else prefer a
    real aggregate (``count``/``sum``) which Spark combines map-side."""
    agg = F.collect_list(value)
    if sort:
        agg = F.array_sort(agg)
    return df.groupBy(key).agg(agg.alias("values"))


def count_by(df: DataFrame, *keys) -> DataFrame:
    """``countByKey`` / ``countByValue`` / ``groupBy().count()``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def having(df: DataFrame, keys, agg: Column, cond) -> DataFrame:
    """Aggregate then threshold (SQL HAVING)."""
    return df.groupBy(*keys).agg(agg).where(cond)


def fraction_of_total(df: DataFrame, count_col: str = "count", name: str = "fraction") -> DataFrame:
    """Share of each row in the total.  The total is a one-row global
    aggregate cross-joined as a scalar (a broadcast of exactly one row), so
    no un-partitioned window is needed."""
    total = df.agg(F.sum(count_col).alias("__total"))
    return (df.crossJoin(F.broadcast(total))
              .withColumn(name, F.col(count_col) / F.col("__total")).drop("__total"))


def histogram_even(df: DataFrame, col: str, buckets: int) -> DataFrame:
    """``histogram(n)`` — n equal-width buckets over [min, max]; the last
    bucket is closed.  Min/max come from a one-row aggregate (broadcast)."""
    mm = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    x = df.select(col).crossJoin(F.broadcast(mm))
    width = (F.col("__hi") - F.col("__lo")) / F.lit(buckets)
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("__lo")) / width), F.lit(buckets - 1))).cast("int")
    counted = x.where(F.col(col).isNotNull()).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    grid = mm.select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"),
                     "__lo", "__hi")
    return (grid.join(counted, "bucket", "left")
                .select("bucket",
                        (F.col("__lo") + F.col("bucket") * (F.col("__hi") - F.col("__lo")) / buckets).alias("lower"),
                        F.coalesce("count", F.lit(0)).alias("count")))


def bucket_expr(col: Column, bounds: list[float]) -> Column:
    """Index of the bucket [b_i, b_{i+1}) holding ``col``; the last bucket is
    closed on the right; values outside [b_0, b_n] give NULL."""
    n = len(bounds) - 1
    expr = F.lit(None).cast("int")
    for i in reversed(range(n)):
        lo, hi = bounds[i], bounds[i + 1]
        inside = (col >= F.lit(lo)) & ((col < F.lit(hi)) if i < n - 1 else (col <= F.lit(hi)))
        expr = F.when(inside, F.lit(i)).otherwise(expr)
    return expr


def histogram_bounds(df: DataFrame, col: str, bounds: list[float]) -> DataFrame:
    """``histogram([b0, ..., bn])`` — explicit bounds, outside dropped,
    last bucket closed.  Empty buckets are reported with count 0."""
    b = bucket_expr(F.col(col), bounds)
    counted = df.select(b.alias("bucket")).where("bucket IS NOT NULL").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, float(bounds[i]), float(bounds[i + 1])) for i in range(len(bounds) - 1)],
                                 "bucket int, lower double, upper double")
    return grid.join(counted, "bucket", "left").select(
        "bucket", "lower", "upper", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def percentile_by_rank(df: DataFrame, keys: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """Exact percentiles per group, interpolated between neighbours as
    ``percentile`` does, for groups of any size: (keys, a column per fraction).

    ``percentile`` keeps every value of a group in one task.  Here equal values are
    counted first (so a frequent value is one row), the counts are dealt by ranges
    of (keys, value), and one sum per group and range tells which range holds a
    wanted rank; only those ranges are then read in order.  Nulls are left out; a
    group of nulls has null percentiles; null keys are a group."""
    counts = df.groupBy(*keys, F.col(value).alias("__v")).agg(F.count(value).alias("__c"))
    rows = placed_by_range(counts, [*keys, "__v"], "percentile").drop("__place")
    ranges = rows.groupBy(*keys, "__pid").agg(F.sum("__c").alias("__n"))
    group = Window.partitionBy(*keys)
    ranges = (ranges.withColumn("__total", F.sum("__n").over(group))
              .withColumn("__before", F.sum("__n").over(group.orderBy("__pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q")) for name, q in fractions.items()])
    place = F.col("__w.q") * (F.col("__total") - 1)
    targets = (ranges.where("__total > 0").withColumn("__w", F.explode(wanted))
               .withColumn("__rank", F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))))
               .where("__rank >= __before AND __rank < __before + __n"))
    targets = targets.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__pid").alias("__tp"), "__before",
                             F.col("__w.name").alias("__name"), place.alias("__place"), "__rank")
    same = F.col("__pid") == F.col("__tp")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    spots = targets.select("__tp", *[f"__k{i}" for i in range(len(keys))]).distinct()
    inside = Window.partitionBy(*keys, "__pid").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    upto = (rows.where("__c > 0").join(spots, same, "left_semi")
            .withColumn("__upto", F.sum("__c").over(inside)))
    hit = upto.join(targets, same & (F.col("__rank") - F.col("__before") < F.col("__upto"))
                    & (F.col("__rank") - F.col("__before") >= F.col("__upto") - F.col("__c")))
    low, high = F.min(F.struct("__rank", "__v")), F.max(F.struct("__rank", "__v"))
    named = hit.groupBy(*keys, "__name", "__place").agg(low.alias("__lo"), high.alias("__hi")).withColumn(
        "__value", F.col("__lo.__v") + (F.col("__hi.__v") - F.col("__lo.__v")) * (F.col("__place") - F.floor("__place")))
    out = named.groupBy(*keys).agg(*[F.max(F.when(F.col("__name") == n, F.col("__value"))).alias(n) for n in fractions])
    return _null_safe_left(ranges.select(*keys).distinct(), out, keys)


def _null_safe_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null."""
    renamed = right.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return left.join(renamed, same, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def count_within(df: DataFrame, seconds: float, confidence: float = 0.95) -> int:
    """The number of rows as known after ``seconds``: exact if the count has
    ended by then, else the mean of what the finished tasks suggest."""
    return df.select(F.lit(1).alias("one")).rdd.countApprox(int(1000 * seconds), confidence)


def weighted_entropy(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Σ_clusters n_c · H(labels in c) / N — size-weighted label entropy
    (natural log).  Two small aggregates; no per-cluster collect."""
    cnt = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(cluster)
    per = (cnt.withColumn("__nc", F.sum("__n").over(w))
              .withColumn("__p", F.col("__n") / F.col("__nc"))
              .groupBy(cluster).agg(F.first("__nc").alias("__nc"),
                                    (-F.sum(F.col("__p") * F.log(F.col("__p")))).alias("__h")))
    return per.agg((F.sum(F.col("__nc") * F.col("__h")) / F.sum("__nc")).alias("weighted_entropy"))


def entropy_of_counts(counts: list[int]) -> float:
    """Entropy of one label-count vector (driver-side helper for tests)."""
    n = sum(counts)
    return -sum((c / n) * math.log(c / n) for c in counts if c > 0)


def elementwise_sum(df: DataFrame, array_col: str) -> DataFrame:
    """Vector accumulator — element-wise sum of an array column.
    ``posexplode`` then sum by position: partial aggregation per position."""
    e = df.select(F.posexplode(array_col).alias("pos", "v"))
    return e.groupBy("pos").agg(F.sum("v").alias("total"))


def observe_counts(df: DataFrame, name: str, **exprs: Column):
    """Side counters while filtering — ``DataFrame.observe`` metrics
    are computed exactly once per action (unlike accumulators updated in
    transformations).  Returns (observed_df, Observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, *[e.alias(k) for k, e in exprs.items()]), obs


def extreme_by(df: DataFrame, keys: list[str], order: str, value: str, prefix: str) -> DataFrame:
    """The row with the largest and the smallest numeric ``order`` per
    group (``max_by`` / ``min_by``), ties broken by the smallest ``value``.

    ``min(struct(-order, value))`` picks the largest order and, among equal
    orders, the smallest value; both are ordinary partial aggregates."""
    big = F.min(F.struct((-F.col(order)).alias("o"), F.col(value).alias("v")))
    small = F.min(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    return (df.groupBy(*keys).agg(big.alias("__b"), small.alias("__s"))
              .select(*keys,
                      F.col("__b.v").alias(f"biggest_{prefix}"), (-F.col("__b.o")).alias(f"biggest_{order}"),
                      F.col("__s.v").alias(f"smallest_{prefix}"), F.col("__s.o").alias(f"smallest_{order}")))
