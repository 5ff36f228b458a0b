"""Catalogue: user-function shapes — each is checked against
the SQL form of its native twin."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import udfs as U
from ..sources.tables import Tables
from .registry import query


@query("pandas_udf_series_and_iterators", "K3,K5,K6", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1.0 - l_discount) AS net,
       CAST(l_linenumber AS BIGINT) + 1 AS next_line, l_quantity * l_tax AS qty_tax
FROM lineitem
""")
def _(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber", U.net_price("l_extendedprice", "l_discount").alias("net"),
                     U.plus_one_iter(F.col("l_linenumber").cast("bigint")).alias("next_line"),
                     U.product_iter("l_quantity", "l_tax").alias("qty_tax"))


@query("pandas_udf_struct_in_out", "K4", """
SELECT c_custkey, CAST(length(c_name) AS BIGINT) AS name_len, upper(c_name) AS name_upper FROM customer
""")
def _(spark, sf):
    c = Tables(spark, sf).customer
    r = U.describe_name(F.struct(F.col("c_name").alias("name")))
    return c.select("c_custkey", r.alias("r")).select("c_custkey", "r.name_len", "r.name_upper")


@query("python_udf_registered_sql", "K1,K2", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 THEN 'big' ELSE 'small' END AS size_class FROM orders
""")
def _(spark, sf):
    U.register_sql(spark, "kestrel_size_class", lambda p: "big" if p >= 200000 else "small", "string")
    Tables(spark, sf).orders.createOrReplaceTempView("orders_udf_v")
    return spark.sql("SELECT o_orderkey, kestrel_size_class(o_totalprice) AS size_class FROM orders_udf_v")


@query("grouped_map_subtract_mean", "K8", """
SELECT o_orderkey, o_orderstatus,
       floor((o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_orderstatus)) * 1e4 + 0.5) / 1e4 AS centred
FROM orders
""", note="native window twin of the grouped-map UDF (bounded memory per group)")
def _(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    c = U.subtract_mean_native(o, "o_orderstatus", "o_totalprice")
    return c.select("o_orderkey", "o_orderstatus", fixed("o_totalprice", 4).alias("centred"))


@query("grouped_map_centred_per_customer", "K8", """
SELECT o_orderkey, o_custkey, floor((o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_custkey)) * 1e4 + 0.3) / 1e4 AS centred
FROM orders
""", note="a customer's orders are a bounded group; halves don't fall on the border of 0.3")
def _(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return U.subtract_mean_grouped(o, "o_custkey", "o_totalprice").select(
        "o_orderkey", "o_custkey", (F.floor(F.col("o_totalprice") * 1e4 + 0.3) / 1e4).alias("centred"))


@query("pandas_series_to_scalar_per_customer", "K7", """
SELECT o_orderkey, o_custkey, floor(avg(o_totalprice) OVER w * 100 + 0.37) / 100 AS mean_price, count(*) OVER w AS n
FROM orders WINDOW w AS (PARTITION BY o_custkey)
""", note="grouped and over a window; a customer's orders are a bounded group")
def _(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    over = o.withColumn("m", U.mean_udf("o_totalprice").over(Window.partitionBy("o_custkey")))
    sums = o.groupBy("o_custkey").agg(U.mean_udf("o_totalprice").alias("g"), U.sum_udf("o_totalprice").alias("s"))
    return over.join(sums, "o_custkey").select(
        "o_orderkey", "o_custkey", (F.floor(F.col("m") * 100 + 0.37) / 100).alias("mean_price"),
        F.round(F.col("s") / F.col("g")).cast("bigint").alias("n"))


@query("shipped_helper_module", "K11,K3", """
SELECT c_custkey, CAST(coalesce(list_sum(list_transform(regexp_extract_all(c_name, '[0-9]'), lambda d: CAST(d AS INTEGER))), 0) AS BIGINT) AS digits
FROM customer
""")
def _(spark, sf):
    return U.with_shipped_digit_sum(Tables(spark, sf).customer, "c_name", "digits").select("c_custkey", "digits")


@query("python_table_function_split", "K12,B2", """
SELECT item_id, count(*) AS n_words FROM (SELECT item_id, unnest(regexp_split_to_array(trim(text), '\\s+')) AS w FROM benchmark)
GROUP BY item_id
""")
def _(spark, sf):
    split = U.make_split_udtf()
    spark.udtf.register("kestrel_split_words", split)
    Tables(spark, sf).benchmark.createOrReplaceTempView("bench_udtf_v")
    return spark.sql("SELECT item_id, count(*) AS n_words FROM bench_udtf_v, "
                     "LATERAL kestrel_split_words(text) GROUP BY item_id")
