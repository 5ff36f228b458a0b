"""Daily loads from a folder tree ``year=/month=/day=`` and their backfill with a
ledger (SURVEY J12, J13)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Day = tuple[int, int, int]

LEDGER = "year int, month int, day int, attempt int, status string, rows long, error string"


def days_in_tree(spark: SparkSession, root: str) -> list[Day]:
    """The days that have files under ``root``, in the order of their numbers
    (so day 10 comes after day 9).  Only paths are listed, no file is read; a
    calendar bounds how many come to the driver."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")

    def part(name: str) -> Column:
        return F.regexp_extract("path", rf"/{name}=(\d+)/", 1).try_cast("int").alias(name)

    days = paths.select(part("year"), part("month"), part("day")).dropna().distinct()
    return sorted(tuple(r) for r in days.collect())


def load_day(spark: SparkSession, root: str, table: str, day: Day, fmt: str = "parquet", options: dict | None = None,
             schema: StructType | str | None = None, transform: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Load one day's folder into the partitioned files at ``table``,
    replacing that day and no other, so a load can be repeated; returns the rows
    that the day has then."""
    y, m, d = day
    reader = spark.read.format(fmt).options(**(options or {}))
    df = (reader.schema(schema) if schema else reader).load(f"{root}/year={y}/month={m}/day={d}")
    df = transform(df) if transform else df
    parts = {"year": y, "month": m, "day": d}
    (df.withColumns({k: F.lit(v) for k, v in parts.items()}).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(table))
    return spark.read.parquet(f"{table}/year={y}/month={m}/day={d}").count()


def backfill(spark: SparkSession, days: list[Day], loader: Callable[[Day], int], ledger: str) -> DataFrame:
    """Load the days in order; a day that fails is noted and the others go on.
    Every attempt becomes a row of the ledger (Parquet at ``ledger``), numbered per
    day across runs.  Returns this run's rows."""
    before = {(r.year, r.month, r.day): r.n for r in _attempts(spark, ledger)}
    rows = []
    for day in sorted(days):
        n = before.get(day, 0) + 1
        try:
            rows.append((*day, n, "ok", int(loader(day)), None))
        except Exception as e:  # noqa: BLE001 - the ledger has it, and the next run tries again
            rows.append((*day, n, "failed", 0, f"{type(e).__name__}: {str(e)[:300]}"))
    run = spark.createDataFrame(rows, LEDGER)
    run.coalesce(1).write.mode("append").parquet(ledger)
    return run


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger)


def _attempts(spark: SparkSession, ledger: str) -> list:
    from pyspark.errors import AnalysisException
    try:
        seen = read_ledger(spark, ledger).groupBy("year", "month", "day").agg(F.max("attempt").alias("n"))
        return seen.collect()                       # a row per day
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []                                   # the first run


def open_days(spark: SparkSession, ledger: str) -> list[Day]:
    """The days whose last attempt failed."""
    last = Window.partitionBy("year", "month", "day").orderBy(F.desc("attempt"))
    failed = (read_ledger(spark, ledger).withColumn("__n", F.row_number().over(last))
              .where("__n = 1 AND status = 'failed'").select("year", "month", "day"))
    return sorted(tuple(r) for r in failed.collect())
