"""Catalogue: aggregation on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import udfs as U
from ..operators import aggregate as A
from ..session import written
from ..sources.tables import Tables
from .registry import query


def T(spark, sf):
    return Tables(spark, sf)


@query("global_count_reduce", "D1,D2", """
SELECT count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS reduced FROM lineitem
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    return li.agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("reduced"))


@query("global_stats_summary", "D3,D4,D5", """
SELECT count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS stdev,
       round(var_pop(l_quantity), 6) AS variance, max(l_quantity) AS max, min(l_quantity) AS min,
       round(sum(l_quantity), 2) AS total
FROM lineitem
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    c = F.col("l_quantity")
    return li.agg(F.count(c).alias("count"), F.round(F.avg(c), 6).alias("mean"),
                  F.round(F.stddev_pop(c), 6).alias("stdev"), F.round(F.var_pop(c), 6).alias("variance"),
                  F.max(c).alias("max"), F.min(c).alias("min"), F.round(F.sum(c), 2).alias("total"))


@query("aggregate_sum_count_by_key", "D6,D11,D12", """
SELECT l_returnflag, round(sum(l_quantity), 2) AS total, count(*) AS n,
       round(sum(l_quantity) / count(*), 6) AS mean
FROM lineitem GROUP BY l_returnflag
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    sc = A.sum_count(li, "l_quantity", ["l_returnflag"])
    return sc.select("l_returnflag", F.round("total", 2).alias("total"), "n",
                     F.round(F.col("total") / F.col("n"), 6).alias("mean"))


@query("tree_aggregate_two_level", "D7", """
SELECT round(sum(l_extendedprice), 2) AS total, count(*) AS n FROM lineitem
""")
def _(spark, sf):
    r = A.tree_aggregate(T(spark, sf).lineitem.select("l_extendedprice"), "l_extendedprice", fanin=4)
    return r.select(F.round("total", 2).alias("total"), "n")


@query("group_to_lists_bounded", "D8,D9", """
SELECT n_regionkey, list_sort(list(n_name)) AS names FROM nation GROUP BY n_regionkey
""")
def _(spark, sf):
    return A.group_to_lists(T(spark, sf).nation, "n_regionkey", "n_name").withColumnRenamed("values", "names")


@query("reduce_by_key_sum", "D10,D14", """
SELECT l_suppkey, round(sum(l_quantity), 2) AS qty, round(sum(l_extendedprice), 2) AS revenue,
       count(*) AS n_lines, max(l_discount) AS max_disc
FROM lineitem GROUP BY l_suppkey
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    return li.groupBy("l_suppkey").agg(F.round(F.sum("l_quantity"), 2).alias("qty"),
                                       F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
                                       F.count(F.lit(1)).alias("n_lines"), F.max("l_discount").alias("max_disc"))


@query("count_by_key_value", "D13,D15", """
SELECT o_orderpriority, o_orderstatus, count(*) AS count FROM orders GROUP BY 1, 2
""")
def _(spark, sf):
    return A.count_by(T(spark, sf).orders, "o_orderpriority", "o_orderstatus").orderBy(F.desc("count"))


@query("sum_distinct_count_distinct", "D16,D17,D18", """
SELECT l_linestatus, CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS sum_distinct_line,
       count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_orderkey) AS n_orders
FROM lineitem GROUP BY l_linestatus
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    return li.groupBy("l_linestatus").agg(F.sum_distinct("l_linenumber").alias("sum_distinct_line"),
                                          F.count_distinct("l_suppkey").alias("n_suppliers"),
                                          F.count_distinct("l_orderkey").alias("n_orders"))


@query("ratio_total_over_distinct", "D19", """
SELECT o_orderpriority, CAST(floor(count(*) / count(DISTINCT o_custkey)) AS BIGINT) AS orders_per_customer
FROM orders GROUP BY o_orderpriority
""")
def _(spark, sf):
    o = T(spark, sf).orders
    return o.groupBy("o_orderpriority").agg(
        F.floor(F.count(F.lit(1)) / F.count_distinct("o_custkey")).cast("bigint").alias("orders_per_customer"))


_CUBE_SQL = """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS yr, o_orderstatus AS status,
       CAST(grouping(year(o_orderdate), o_orderstatus) AS INTEGER) AS gid,
       count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY {kind}(year(o_orderdate), o_orderstatus)
"""


def _grouped(spark, sf, kind):
    o = T(spark, sf).orders.select(F.year("o_orderdate").cast("string").alias("yr"),
                                   F.col("o_orderstatus").alias("status"), "o_totalprice")
    g = o.cube("yr", "status") if kind == "cube" else o.rollup("yr", "status")
    return g.agg(F.grouping_id().cast("int").alias("gid"), F.count(F.lit(1)).alias("n"),
                 F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("cube_dataframe", "D21,D26,L5", _CUBE_SQL.format(kind="CUBE"))
def _(spark, sf):
    return _grouped(spark, sf, "cube")


@query("rollup_dataframe", "D23", _CUBE_SQL.format(kind="ROLLUP"))
def _(spark, sf):
    return _grouped(spark, sf, "rollup")


@query("cube_sql_with_cube", "D22", """
SELECT o_orderpriority AS pri, o_orderstatus AS status, count(*) AS n
FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)
""")
def _(spark, sf):
    T(spark, sf).orders.createOrReplaceTempView("orders_v")
    return spark.sql("SELECT o_orderpriority AS pri, o_orderstatus AS status, count(*) AS n "
                     "FROM orders_v GROUP BY o_orderpriority, o_orderstatus WITH CUBE")


@query("rollup_sql_filtered", "D24,L5", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS yr, CAST(month(o_orderdate) AS VARCHAR) AS mn,
       round(avg(o_totalprice), 4) AS avg_price, count(*) AS n
FROM orders WHERE o_orderstatus = 'F'
GROUP BY ROLLUP (year(o_orderdate), month(o_orderdate))
HAVING count(*) > 10
""")
def _(spark, sf):
    T(spark, sf).orders.createOrReplaceTempView("orders_v")
    return spark.sql("""
        SELECT CAST(year(o_orderdate) AS STRING) AS yr, CAST(month(o_orderdate) AS STRING) AS mn,
               round(avg(o_totalprice), 4) AS avg_price, count(*) AS n
        FROM orders_v WHERE o_orderstatus = 'F'
        GROUP BY year(o_orderdate), month(o_orderdate) WITH ROLLUP
        HAVING count(*) > 10 ORDER BY yr, mn""")


@query("grouping_sets_year_month", "D25", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS yr, CAST(month(o_orderdate) AS VARCHAR) AS mn,
       count(*) AS n, round(max(o_totalprice), 2) AS top
FROM orders GROUP BY GROUPING SETS ((year(o_orderdate)), (year(o_orderdate), month(o_orderdate)))
""")
def _(spark, sf):
    o = T(spark, sf).orders.select(F.year("o_orderdate").cast("string").alias("yr"),
                                   F.month("o_orderdate").cast("string").alias("mn"), "o_totalprice")
    return o.groupingSets([["yr"], ["yr", "mn"]], "yr", "mn").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("o_totalprice"), 2).alias("top"))


@query("cube_overall_rows", "D26", """
SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
""")
def _(spark, sf):
    o = T(spark, sf).orders
    c = o.cube("o_orderstatus", "o_orderpriority").agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return c.where(F.col("gid") == 3).select("n", "total")


@query("pivot_fixed_values", "D27", """
SELECT l_suppkey,
       round(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 2) AS A,
       round(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 2) AS N,
       round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 2) AS R
FROM lineitem GROUP BY l_suppkey
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    p = li.groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity"))
    return p.select("l_suppkey", *[F.round(c, 2).alias(c) for c in ("A", "N", "R")])


@query("group_by_nested_field", "D29,H31", """
SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n
FROM orders GROUP BY 1, 2
""")
def _(spark, sf):
    o = T(spark, sf).orders.select(F.struct(F.col("o_orderstatus").alias("status"),
                                            F.col("o_orderpriority").alias("priority")).alias("info"))
    return o.groupBy("info.status", "info.priority").agg(F.count(F.lit(1)).alias("n"))


@query("percentile_exact_and_approx", "D33,L29", """
SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.5), 4) AS median,
       round(quantile_cont(o_totalprice, 0.9), 4) AS p90
FROM orders GROUP BY o_orderstatus
""")
def _(spark, sf):
    o = T(spark, sf).orders
    p = A.percentile_by_rank(o, ["o_orderstatus"], "o_totalprice", {"median": 0.5, "p90": 0.9})
    return p.select("o_orderstatus", F.round("median", 4).alias("median"), F.round("p90", 4).alias("p90"))


@query("percentile_approx_sketch", "D33,D36", note="rows-only: approximate sketches differ by engine")
def _(spark, sf):
    o = T(spark, sf).orders
    return o.groupBy("o_orderstatus").agg(F.percentile_approx("o_totalprice", 0.5, 10000).alias("median_approx"),
                                          F.approx_count_distinct("o_custkey").alias("customers_approx"))


@query("count_within_a_time_limit", "D36", """
SELECT count(*) AS n FROM orders
""", note="a limit that the count does not reach, so the estimate is the count")
def _(spark, sf):
    n = A.count_within(T(spark, sf).orders.select("o_orderkey"), 600)
    return spark.range(1).select(F.lit(n).cast("bigint").alias("n"))


@query("histogram_even_buckets", "D34", """
WITH mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bucket
      FROM orders, mm WHERE o_totalprice IS NOT NULL)
SELECT g.bucket, COALESCE(c.count, 0) AS count
FROM (SELECT unnest(range(0, 10))::INTEGER AS bucket) g
LEFT JOIN (SELECT bucket, count(*) AS count FROM b GROUP BY bucket) c ON g.bucket = c.bucket
""")
def _(spark, sf):
    return A.histogram_even(T(spark, sf).orders, "o_totalprice", 10).select("bucket", "count")


@query("histogram_explicit_bounds", "D35", """
WITH b AS (SELECT CASE WHEN o_totalprice >= 0 AND o_totalprice < 50000 THEN 0
                       WHEN o_totalprice >= 50000 AND o_totalprice < 150000 THEN 1
                       WHEN o_totalprice >= 150000 AND o_totalprice < 300000 THEN 2
                       WHEN o_totalprice >= 300000 AND o_totalprice <= 400000 THEN 3 END AS bucket FROM orders)
SELECT g.bucket, COALESCE(c.count, 0) AS count
FROM (SELECT unnest(range(0, 4))::INTEGER AS bucket) g
LEFT JOIN (SELECT bucket, count(*) AS count FROM b WHERE bucket IS NOT NULL GROUP BY bucket) c ON g.bucket = c.bucket
""")
def _(spark, sf):
    h = A.histogram_bounds(T(spark, sf).orders, "o_totalprice", [0, 50000, 150000, 300000, 400000])
    return h.select("bucket", "count")


@query("fractions_of_total", "D37,D15", """
SELECT o_orderstatus, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 8) AS fraction
FROM orders GROUP BY o_orderstatus
""")
def _(spark, sf):
    c = A.count_by(T(spark, sf).orders, "o_orderstatus")
    return A.fraction_of_total(c).withColumn("fraction", F.round("fraction", 8))


@query("weighted_label_entropy", "D38,M10", """
WITH c AS (SELECT c_nationkey AS cl, c_mktsegment AS lb, count(*) AS n FROM customer GROUP BY 1, 2),
p AS (SELECT cl, n, sum(n) OVER (PARTITION BY cl) AS nc FROM c),
h AS (SELECT cl, max(nc) AS nc, -sum((n / nc) * ln(n / nc)) AS h FROM p GROUP BY cl)
SELECT round(sum(nc * h) / sum(nc), 8) AS weighted_entropy FROM h
""")
def _(spark, sf):
    e = A.weighted_entropy(T(spark, sf).customer, "c_nationkey", "c_mktsegment")
    return e.select(F.round("weighted_entropy", 8).alias("weighted_entropy"))


@query("pandas_grouped_aggregate", "D39,L29", """
SELECT o_orderstatus, round(avg(o_totalprice), 4) AS mean_price, round(sum(o_totalprice), 2) AS sum_price
FROM orders GROUP BY o_orderstatus
""")
def _(spark, sf):
    o = T(spark, sf).orders
    s = U.mergeable_sums(o, ["o_orderstatus"], "o_totalprice")
    return s.select("o_orderstatus", F.round("mean", 4).alias("mean_price"), F.round("total", 2).alias("sum_price"))


@query("vector_elementwise_sum", "D40", """
SELECT pos, round(sum(v), 4) AS total FROM (
  SELECT generate_subscripts(embedding, 1) - 1 AS pos, unnest(embedding) AS v FROM embeddings)
GROUP BY pos
""")
def _(spark, sf):
    s = A.elementwise_sum(T(spark, sf).embeddings, "embedding")
    return s.select("pos", F.round("total", 4).alias("total"))


@query("observed_side_counters", "", """
SELECT count(*) AS kept FROM events WHERE event_type <> 'error'
""")
def _(spark, sf):
    e = T(spark, sf).events
    obs_df, obs = A.observe_counts(e, "event_counts", rows=F.count(F.lit(1)),
                                   errors=F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)))
    return obs_df.where("event_type <> 'error'").agg(F.count(F.lit(1)).alias("kept"))


@query("two_level_aggregate", "D30", """
WITH city AS (SELECT c_nationkey, c_mktsegment, sum(c_acctbal) AS pop FROM customer GROUP BY 1, 2)
SELECT c_nationkey, round(avg(pop), 4) AS avg_city_pop FROM city GROUP BY c_nationkey
""")
def _(spark, sf):
    c = T(spark, sf).customer
    city = c.groupBy("c_nationkey", "c_mktsegment").agg(F.sum("c_acctbal").alias("pop"))
    return city.groupBy("c_nationkey").agg(F.round(F.avg("pop"), 4).alias("avg_city_pop"))


@query("having_threshold", "D32", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15
""")
def _(spark, sf):
    return A.having(T(spark, sf).orders, ["o_custkey"], F.count(F.lit(1)).alias("n"), F.col("n") > 15)


@query("observed_counters_read_back", "D41", """
SELECT count(*) AS rows_seen, count(*) FILTER (WHERE event_type = 'error') AS errors,
       count(*) FILTER (WHERE event_type <> 'error') AS kept
FROM events
""")
def _(spark, sf):
    e = T(spark, sf).events.select("event_id", "event_type")
    seen, obs = A.observe_counts(e, "event_counts_read", rows_seen=F.count(F.lit(1)),
                                 errors=F.count(F.when(F.col("event_type") == "error", 1)))
    kept = written(seen.where("event_type <> 'error'"), "observed-events")     # the one pass that counts
    counters = obs.get
    return kept.agg(F.lit(counters["rows_seen"]).alias("rows_seen"), F.lit(counters["errors"]).alias("errors"),
                    F.count(F.lit(1)).alias("kept"))
