"""Projection, filter, rename, partitioning and set helpers (SURVEY 2.B,
2.F, 2.G).  Thin by design: these are Spark's own operators; the helpers
only fix the conventions (explicit names, deterministic tie-breaks)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashed_number


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by dictionary, keeping unmapped names."""
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Positional rename of every column (``toDF``) to disambiguate a
    self / cross join."""
    return df.toDF(*[f"{prefix}{c}" for c in df.columns])


def key_by(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """``keyBy(f)`` → (key, value struct of the whole row)."""
    return df.select(key.alias(name), F.struct(*df.columns).alias("value"))


def split_good_bad(df: DataFrame, ok: Column):
    """One parse, an ``ok`` flag, two filtered views.  Returns
    (flagged, good, bad); counts of each come from one aggregate over
    ``flagged`` instead of two extra scans."""
    flagged = df.withColumn("ok", ok)
    return flagged, flagged.where("ok").drop("ok"), flagged.where("NOT ok").drop("ok")


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """``top`` / ``takeOrdered`` — ``orderBy(...).limit(k)`` plans as
    TakeOrderedAndProject: each task keeps its own k best, the driver merges
    k × tasks rows.  Callers pass a total order (ties broken by a key)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, k: int, keys: list[str], *order: Column, name: str = "rank") -> DataFrame:
    """Top-k per group via ``row_number`` over a partitioned window."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def kth_largest(df: DataFrame, col: str, k: int) -> DataFrame:
    """F8: the k-th largest value (sort desc, take k, last) as one row."""
    return df.select(col).orderBy(F.col(col).desc()).limit(k).agg(F.min(col).alias("kth"))


def partition_sizes(df: DataFrame) -> DataFrame:
    """rows per partition (``getNumPartitions`` / ``glom`` sizes)."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def session_with_width(spark: SparkSession, width: int) -> SparkSession:
    """a session of its own (the caller's settings stay) whose shuffles have
    exactly ``width`` partitions: adaptive planning would merge small ones."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", width)
    own.conf.set("spark.sql.adaptive.enabled", "false")
    return own


def foreach_counted(df: DataFrame, flagged) -> tuple[int, int]:
    """visit every row for its side effect, here two counters that the tasks
    add to (once per partition) and the driver reads back: rows, and rows that
    ``flagged(row)`` holds for.  Spark adds a task's update once, however often the
    task ran."""
    sc = df.sparkSession.sparkContext
    seen, hits = sc.accumulator(0), sc.accumulator(0)

    def visit(rows) -> None:
        n = h = 0
        for r in rows:
            n += 1
            h += bool(flagged(r))
        seen.add(n)
        hits.add(h)

    df.foreachPartition(visit)
    return seen.value, hits.value


def plan_text(df: DataFrame) -> DataFrame:
    """one row ``plan``, the formatted physical plan of ``df`` as a table that
    can be queried; nothing of ``df`` is run."""
    return df.sparkSession.sql("EXPLAIN FORMATTED SELECT * FROM {df}", df=df)


def partition_by_rule(df: DataFrame, rule: Column, n: int) -> DataFrame:
    """F16: custom partitioner — rows go to partition ``rule`` (an int in
    [0, n)).  Uses ``repartitionById`` (direct partition ids, no hashing)."""
    return df.repartitionById(n, rule)


def cross_join_bounded(a: DataFrame, b: DataFrame, max_output: int = 1_000_000) -> DataFrame:
    """C11: cartesian product, allowed only when it has at most ``max_output``
    rows (a bounded count per side).  Larger products raise instead of exploding."""
    n, m = (x.limit(max_output + 1).count() for x in (a, b))
    if n * m > max_output:
        raise ValueError("cross join refused: the product exceeds the bound")
    return a.crossJoin(b)


def hash_fraction(*cols, seed: int = 0) -> Column:
    """Deterministic pseudo-random number in [0, 1) from key columns
    (xxhash64), for repeatable sampling and splits."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def fixed_size_sample_per_group(df: DataFrame, group: Column, n: int, seed: int = 7,
                                key_cols: list[str] | None = None) -> DataFrame:
    """N shuffled rows per group (e.g. per input file).  Order is a
    seeded hash of the row's key, so the draw is repeatable and SQL can repeat it.
    The first n of hashed parts of a group meet in the end, so no task sorts a
    whole group."""
    key_cols = key_cols or df.columns
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.withColumn("__draw", hashed_number(*key_cols, F.lit(seed)))
    for part in (F.pmod(F.xxhash64(*key_cols), F.lit(parts)), F.lit(0)):
        w = Window.partitionBy(group, part).orderBy("__draw", *key_cols)
        df = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
    return df.drop("__rn", "__draw")


def random_split_hashed(df: DataFrame, weights: list[float], key_cols: list[str], seed: int = 42) -> DataFrame:
    """``df`` with ``split``, the number of the part that a row falls into, by a
    hash of its key that SQL can repeat; the parts are disjoint and whole however
    often, and in whatever partitioning, the rows are read."""
    total, upto, expr = float(sum(weights)), 0.0, F.lit(len(weights) - 1)
    bounds = []
    for w in weights[:-1]:
        upto += w / total
        bounds.append(int(round(upto, 12) * 4294967296))
    df = df.withColumn("__u", hashed_number(*key_cols, F.lit(seed)))
    for i in reversed(range(len(bounds))):
        expr = F.when(F.col("__u") < bounds[i], i).otherwise(expr)
    return df.withColumn("split", expr).drop("__u")


def poisson_bounds(mean: float) -> list[float]:
    """Shares of the Poisson law up to 0, 1, 2, ... until what is left is below the
    32 bits of a hashed draw."""
    bounds, term, upto = [], math.exp(-mean), 0.0
    while 1 - upto >= 2.0 ** -33 and len(bounds) < 10_000:
        upto += term
        bounds.append(upto)
        term *= mean / len(bounds)
    return bounds


def poisson_copies(df: DataFrame, mean: float, key_cols: list[str], seed: int) -> DataFrame:
    """sampling with replacement: every row as often as the Poisson law of
    ``mean`` draws by a hash of its key (repeatable, unlike ``sample``)."""
    u = hashed_number(*key_cols, F.lit(seed)) / 4294967296
    copies = F.size(F.filter(F.array(*[F.lit(b) for b in poisson_bounds(mean)]), lambda b: b <= u))
    names = df.columns
    return (df.withColumn("__n", copies).where("__n > 0")
              .select(*names, F.explode(F.expr("sequence(1, __n)")).alias("__i")).drop("__i"))


def random_split_exact(df: DataFrame, weights: list[float], key_cols: list[str], seed: int = 42) -> DataFrame:
    """split labels by a hash of the key (exactly repeatable, unlike
    ``randomSplit`` which depends on partitioning)."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        acc += w / total
        bounds.append(acc)
    u = hash_fraction(*key_cols, seed=seed)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(weights) - 1)):
        expr = F.when(u < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return df.withColumn("split", expr)
