"""Versioned parquet tables and partition maintenance.

A table is a folder of parquet data partitioned by ``version`` plus a small
``_history`` parquet log (version, time, operation, rows).  Every change
writes a complete new snapshot under ``version=N+1`` before it becomes
current, so a reader of version N is never disturbed and a failed job
leaves the previous version intact.  Time travel is a partition filter
(pruned at the scan).  No transaction log or file-level vacuum engine is
built: vacuum drops whole old version folders.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_SCHEMA = "version long, ts timestamp, operation string, rows long"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- metadata -------------------------------------------------------
    def _hist_path(self) -> str:
        return f"{self.path}/_history"

    def history(self) -> DataFrame:
        """(version, ts, operation, rows)."""
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(self._hist_path())

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def current_version(self) -> int:
        if not self._exists(self._hist_path()):
            return -1
        r = self.history().agg(F.max("version")).first()[0]
        return -1 if r is None else int(r)

    def _log(self, version: int, op: str, rows: int) -> None:
        row = [(version, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), op, rows)]
        self.spark.createDataFrame(row, HISTORY_SCHEMA).write.mode("append").parquet(self._hist_path())

    # -- reads ------------------------------------------------------------
    def _all(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data")

    def read(self, version: int | None = None, as_of=None) -> DataFrame:
        """Current snapshot, or as of a version number / timestamp
        (greatest version committed at or before it)."""
        if as_of is not None:
            v = (self.history().where(F.col("ts") <= F.lit(as_of).cast("timestamp"))
                 .agg(F.max("version")).first()[0])
            if v is None:
                raise ValueError("no version at or before the given time")
            version = int(v)
        v = self.current_version() if version is None else version
        return self._all().where(F.col("version") == v).drop("version")

    # -- writes -----------------------------------------------------------
    def _commit(self, df: DataFrame, op: str) -> int:
        v = self.current_version() + 1
        out = df.withColumn("version", F.lit(v).cast("long"))
        (out.write.mode("append").partitionBy("version").parquet(f"{self.path}/data"))
        rows = self._all().where(F.col("version") == v).count()
        self._log(v, op, rows)
        return v

    def create(self, df: DataFrame) -> int:
        return self._commit(df, "CREATE")

    def insert(self, df: DataFrame) -> int:
        """Insert from a select."""
        return self._commit(self.read().unionByName(df), "INSERT")

    def update(self, pred: Column, assignments: dict[str, Column]) -> int:
        """Update rows matching ``pred`` (NULL predicate = no match)."""
        cur = self.read()
        hit = F.coalesce(pred, F.lit(False))
        cols = [F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
                for c in cur.columns]
        return self._commit(cur.select(*cols), "UPDATE")

    def delete(self, pred: Column) -> int:
        """Delete rows matching ``pred``."""
        return self._commit(self.read().where(~F.coalesce(pred, F.lit(False))), "DELETE")

    def merge(self, source: DataFrame, keys: list[str], update: bool = False) -> int:
        """Insert source rows with no matching key; with ``update`` also
        replace matched rows (upsert).  Several source rows for one key raise
        (ambiguous merge)."""
        dup = source.groupBy(*keys).count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError("merge source has several rows for one key")
        cur = self.read()
        if update:
            kept = cur.join(source.select(*keys), keys, "left_anti")
            new = kept.unionByName(source.select(*cur.columns))
        else:
            new = cur.unionByName(source.join(cur.select(*keys), keys, "left_anti").select(*cur.columns))
        return self._commit(new, "MERGE")

    def vacuum(self, retain_versions: int = 1) -> list[int]:
        """Drop snapshot folders older than the newest ``retain_versions``
        (the current one is always kept).  Returns the dropped versions."""
        cur = self.current_version()
        keep_from = max(cur - max(retain_versions, 1) + 1, 0)
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        dropped = []
        for v in range(0, keep_from):
            p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/version={v}")
            fs = p.getFileSystem(conf)
            if fs.exists(p):
                fs.delete(p, True)
                dropped.append(v)
        return dropped


def dynamic_overwrite(df: DataFrame, table: str) -> None:
    """Replace only the partitions present in ``df`` (columns by
    position, partition columns last)."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")     # insertInto takes no option for it
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def drop_partition(spark: SparkSession, table: str, spec: dict) -> None:
    """``ALTER TABLE … DROP IF EXISTS PARTITION (…)``."""
    parts = ", ".join(f"{k} = {int(v) if isinstance(v, int) else repr(v)}" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({parts})")


def partition_count(spark: SparkSession, table: str, spec: dict) -> int:
    """Rows in one partition (partition filter → pruned scan)."""
    t = spark.table(table)
    for k, v in spec.items():
        t = t.where(F.col(k) == F.lit(v))
    return t.count()
