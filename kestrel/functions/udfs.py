"""User-function surface.

Every shape the examples use is here, each with an explicit return type.
They exist for parity and for logic no built-in expresses; the catalogue
always pairs them with (or prefers) the native expression, which stays
inside whole-stage codegen.  Pandas forms move Arrow batches, never rows.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# K1: scalar Python UDF with an explicit return type (row-at-a-time: slow
# path, kept for parity only).
def py_udf(fn, return_type="string"):
    return F.udf(fn, return_type)


# K2: register for SQL use.
def register_sql(spark, name: str, fn, return_type="string"):
    return spark.udf.register(name, fn, return_type)


# K3: series -> series.
@F.pandas_udf(T.DoubleType())
def net_price(price: pd.Series, discount: pd.Series) -> pd.Series:
    return price * (1.0 - discount)


# K4: struct in / struct out.
@F.pandas_udf(T.StructType([T.StructField("name_len", T.LongType()), T.StructField("name_upper", T.StringType())]))
def describe_name(s: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"name_len": s["name"].str.len().astype("int64"),
                         "name_upper": s["name"].str.upper()})


# K5: iterator of series -> iterator of series (per-batch setup done once).
@F.pandas_udf(T.LongType())
def plus_one_iter(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in it:
        yield s + 1


# K6: iterator of multiple series.
@F.pandas_udf(T.DoubleType())
def product_iter(it: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in it:
        yield a * b


# K7: series -> scalar (grouped aggregate; also usable over a window).
@F.pandas_udf(T.DoubleType())
def mean_udf(v: pd.Series) -> float:
    return float(v.mean()) if len(v) else float("nan")


@F.pandas_udf(T.DoubleType())
def sum_udf(v: pd.Series) -> float:
    return float(v.sum())


# K7 / D39 for groups of any size: a pandas state per Arrow batch, merged by built-in sums.
def mergeable_sums(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, total, n, mean) of the non-null values of every group.

    A plain pandas aggregate gets each group whole in one Python task.  Here pandas
    sums what an Arrow batch holds of each group, and Spark adds up those states,
    in the tasks first and then by key, so a hot group is a row per task.  Null keys
    are a group; a group of nulls has total 0, n 0 and a null mean."""
    src = df.select(*keys, F.col(value).cast("double").alias("__v"))
    schema = T.StructType([*(src.schema[k] for k in keys), T.StructField("__s", T.DoubleType()), T.StructField("__n", T.LongType())])

    def fn(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            g = pdf.groupby(keys, dropna=False, sort=False)["__v"]
            yield g.agg(__s="sum", __n="count").reset_index()

    return (src.mapInPandas(fn, schema).groupBy(*keys).agg(F.sum("__s").alias("total"), F.sum("__n").alias("n"))
               .withColumn("mean", F.try_divide("total", "n")))


# K8: grouped map — subtract the group mean.  Each group arrives whole in
# one task; use for bounded groups.  The native twin (window average) is
# ``subtract_mean_native`` and is what the catalogue runs at scale.
# Fixed value: calls of the grouped function at most.  A call costs far more than
# the rows of a small group, so groups share calls by a hash of their key and
# pandas tells them apart inside.
GROUP_CALLS = 1 << 10


def subtract_mean_grouped(df: DataFrame, key: str, value: str) -> DataFrame:
    schema = df.schema

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        mean = pdf.groupby(key, dropna=False, sort=False)[value].transform("mean")
        return pdf.assign(**{value: pdf[value] - mean}).drop(columns="__call")

    # a stated width is not merged for being few bytes; the calls are slow, not large
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.withColumn("__call", F.pmod(F.xxhash64(key), F.lit(GROUP_CALLS))).repartition(width, "__call")
              .groupBy("__call").applyInPandas(fn, schema))


def subtract_mean_native(df: DataFrame, key: str, value: str) -> DataFrame:
    from pyspark.sql import Window
    return df.withColumn(value, F.col(value) - F.avg(value).over(Window.partitionBy(key)))


# K9: map over Arrow batches.
def filter_batches(df: DataFrame, col: str, threshold: float) -> DataFrame:
    def fn(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf[pdf[col] >= threshold]

    return df.mapInPandas(fn, df.schema)


# Co-grouped map lives in operators.joins.asof_join_pandas.

# Ship helper modules to executors.
def ship_module(spark, path: str) -> None:
    """Send a module file to all executors, now and later ones; tasks then import
    it by its bare name."""
    spark.sparkContext.addPyFile(path)


def with_shipped_digit_sum(df: DataFrame, text: str, out: str) -> DataFrame:
    """A column made by a module that is shipped to the executors."""
    from . import shipped_helper
    ship_module(df.sparkSession, shipped_helper.__file__)

    @F.pandas_udf(T.LongType())
    def digits(s: pd.Series) -> pd.Series:
        import shipped_helper as helper              # the shipped file, not this package
        return s.map(helper.digit_sum).astype("int64")

    return df.withColumn(out, digits(text))


# Python table function (one row in, several rows out).
def make_split_udtf():
    from pyspark.sql.functions import udtf

    @udtf(returnType="word string, pos int", useArrow=True)
    class SplitWords:
        def eval(self, text: str):
            if text is None:
                return
            for i, w in enumerate(text.split()):
                yield w, i

    return SplitWords
