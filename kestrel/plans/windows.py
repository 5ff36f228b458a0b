"""Catalogue: window analytics.

Windows run on lineitem first aggregated to a unique (supplier, month)
grain, so every ordered frame has a total order and each partition holds at
most one row per month — a hot supplier cannot make a window partition
unbounded."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import udfs as U
from ..operators import windows as W
from ..sources.tables import Tables
from .registry import query

_MONTHLY_SQL = """
WITH m AS (SELECT l_suppkey, strftime(date_trunc('month', l_shipdate), '%Y-%m') AS month,
                  sum(l_quantity) AS qty, sum(l_extendedprice) AS value, count(*) AS n
           FROM lineitem GROUP BY 1, 2)
"""


def monthly(spark, sf):
    li = Tables(spark, sf).lineitem
    return W.monthly_grain(li, "l_suppkey", "l_shipdate", {"qty": F.sum("l_quantity"),
                                                            "value": F.sum("l_extendedprice"),
                                                            "n": F.count(F.lit(1))})


@query("running_sum_range_frame", "E1,E3", _MONTHLY_SQL + """
SELECT l_suppkey, month, CAST(sum(qty) OVER (PARTITION BY l_suppkey ORDER BY month) AS BIGINT) AS cum_qty
FROM m
""")
def _(spark, sf):
    m = monthly(spark, sf)
    return m.select("l_suppkey", "month",
                    W.running_sum("qty", ["l_suppkey"], "month").cast("bigint").alias("cum_qty"))


@query("running_sum_of_product", "E2,L2", _MONTHLY_SQL + """
SELECT l_suppkey, month,
       round(sum(qty * (value / qty)) OVER (PARTITION BY l_suppkey ORDER BY month), 2) AS position_value
FROM m
""")
def _(spark, sf):
    m = monthly(spark, sf)
    return m.select("l_suppkey", "month",
                    F.round(W.running_sum(F.col("qty") * (F.col("value") / F.col("qty")), ["l_suppkey"], "month"), 2)
                    .alias("position_value"))


@query("moving_average_rows", "E4,E5,E9,H26,L4", _MONTHLY_SQL + """
SELECT l_suppkey, month,
       round(avg(qty) OVER (PARTITION BY l_suppkey ORDER BY month ROWS 5 PRECEDING), 4) AS ma6,
       round(avg(qty) OVER (PARTITION BY l_suppkey ORDER BY month ROWS 20 PRECEDING), 4) AS ma21,
       round(avg(qty) OVER (PARTITION BY l_suppkey ORDER BY month ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 4) AS ma4
FROM m
""")
def _(spark, sf):
    m = monthly(spark, sf)
    return m.select("l_suppkey", "month",
                    F.round(W.moving_avg("qty", ["l_suppkey"], "month", 5), 4).alias("ma6"),
                    F.round(W.moving_avg("qty", ["l_suppkey"], "month", 20), 4).alias("ma21"),
                    F.round(W.moving_avg("qty", ["l_suppkey"], "month", 3), 4).alias("ma4"))


@query("row_number_per_key", "E6", _MONTHLY_SQL + """
SELECT l_suppkey, month, row_number() OVER (PARTITION BY l_suppkey ORDER BY month DESC) AS rn FROM m
""")
def _(spark, sf):
    m = monthly(spark, sf)
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("month"))
    return m.select("l_suppkey", "month", F.row_number().over(w).alias("rn"))


@query("whole_partition_frame_udf", "E7,K7", _MONTHLY_SQL + """
SELECT l_suppkey, month, round(qty - avg(qty) OVER (PARTITION BY l_suppkey), 4) AS centred FROM m
""")
def _(spark, sf):
    m = monthly(spark, sf)
    w = (Window.partitionBy("l_suppkey").orderBy("month")
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return m.select("l_suppkey", "month", F.round(F.col("qty") - U.mean_udf("qty").over(w), 4).alias("centred"))


@query("window_then_outer_filter", "E8,B31", _MONTHLY_SQL + """
SELECT l_suppkey, month, cum_qty FROM (
  SELECT l_suppkey, month, CAST(sum(qty) OVER (PARTITION BY l_suppkey ORDER BY month) AS BIGINT) AS cum_qty,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY month DESC) AS rn FROM m)
WHERE rn = 1
""")
def _(spark, sf):
    m = monthly(spark, sf)
    w = Window.partitionBy("l_suppkey").orderBy("month")
    x = m.select("l_suppkey", "month", F.sum("qty").over(w).cast("bigint").alias("cum_qty"),
                 F.row_number().over(w.orderBy(F.desc("month"))).alias("rn"))
    return x.where("rn = 1").drop("rn")


@query("rank_lag_lead", "E6,E9", _MONTHLY_SQL + """
SELECT l_suppkey, month, CAST(qty AS BIGINT) AS qty,
       CAST(COALESCE(lag(qty) OVER (PARTITION BY l_suppkey ORDER BY month), -1) AS BIGINT) AS prev_qty,
       CAST(COALESCE(lead(qty) OVER (PARTITION BY l_suppkey ORDER BY month), -1) AS BIGINT) AS next_qty,
       dense_rank() OVER (PARTITION BY l_suppkey ORDER BY qty DESC) AS qty_rank
FROM m
""")
def _(spark, sf):
    m = monthly(spark, sf)
    w = Window.partitionBy("l_suppkey").orderBy("month")
    return m.select("l_suppkey", "month", F.col("qty").cast("bigint").alias("qty"),
                    F.coalesce(F.lag("qty").over(w), F.lit(-1)).cast("bigint").alias("prev_qty"),
                    F.coalesce(F.lead("qty").over(w), F.lit(-1)).cast("bigint").alias("next_qty"),
                    F.dense_rank().over(Window.partitionBy("l_suppkey").orderBy(F.desc("qty"))).alias("qty_rank"))
