"""Catalogue: projection, filters, joins, ordering, sets (SURVEY 2.B, 2.C,
2.F, 2.G) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from ..operators import joins as J
from ..operators import relational as R
from ..session import written
from ..sources.tables import Tables
from .registry import query


def T(spark, sf):
    return Tables(spark, sf)


# ---------------------------------------------------------------- 2.B ----

@query("project_computed_columns", "B1,B4,B17,B21,B27", """
SELECT l_orderkey, l_linenumber, l_partkey,
       l_extendedprice * (1 - l_discount) AS net_price,
       CAST(l_quantity AS BIGINT) AS qty,
       'line' AS kind
FROM lineitem
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    return (li.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_quantity")
              .withColumn("net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))
              .withColumn("qty", F.col("l_quantity").cast("bigint"))
              .withColumn("kind", F.lit("line"))
              .drop("l_extendedprice", "l_discount", "l_quantity"))


@query("flatmap_explode_split", "B2,H1,H3", """
SELECT c_custkey, part
FROM (SELECT c_custkey, unnest(string_split(c_name, '#')) AS part FROM customer)
""")
def _(spark, sf):
    c = T(spark, sf).customer
    return c.select("c_custkey", F.explode(F.split("c_name", "#")).alias("part"))


@query("filter_column_predicates", "B3,B6,B7", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount
FROM lineitem WHERE l_quantity > 45 AND l_discount >= 0.05
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    return (li.where((F.col("l_quantity") > 45) & (F.col("l_discount") >= 0.05))
              .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


@query("select_expr_strings", "B5", """
SELECT o_orderkey, round(o_totalprice * 2, 2) AS double_price,
       CAST(year(o_orderdate) AS INTEGER) AS yr
FROM orders WHERE o_orderstatus = 'F'
""")
def _(spark, sf):
    o = T(spark, sf).orders
    return (o.where("o_orderstatus = 'F'")
             .selectExpr("o_orderkey", "round(o_totalprice * 2, 2) AS double_price", "year(o_orderdate) AS yr"))


@query("filter_like_patterns", "B8", """
SELECT p_partkey, p_name, p_type FROM part
WHERE p_name LIKE 'red%' OR p_type LIKE '%ECON%'
""")
def _(spark, sf):
    p = T(spark, sf).part
    return (p.where(F.col("p_name").like("red%") | F.col("p_type").like("%ECON%"))
             .select("p_partkey", "p_name", "p_type"))


@query("filter_startswith", "B9", """
SELECT c_custkey, c_name FROM customer WHERE starts_with(c_name, 'Customer#0000001')
""")
def _(spark, sf):
    c = T(spark, sf).customer
    return c.where(F.col("c_name").startswith("Customer#0000001")).select("c_custkey", "c_name")


@query("filter_isin_between", "B10,B11", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 100000 AND 200000
""")
def _(spark, sf):
    o = T(spark, sf).orders
    return (o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                    & F.col("o_totalprice").between(100000, 200000))
             .select("o_orderkey", "o_orderpriority", "o_totalprice"))


@query("filter_case_insensitive", "B12,H6", """
SELECT p_partkey, lower(p_type) AS type_lc, upper(p_name) AS name_uc FROM part
WHERE lower(p_type) = lower('Economy')
""")
def _(spark, sf):
    p = T(spark, sf).part
    return (p.where(F.lower("p_type") == F.lower(F.lit("Economy")))
             .select("p_partkey", F.lower("p_type").alias("type_lc"), F.upper("p_name").alias("name_uc")))


@query("null_handling_after_outer_join", "B13,B14,B15,B16,C5", """
WITH oc AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend
            FROM orders GROUP BY o_custkey)
SELECT c.c_custkey,
       COALESCE(oc.n_orders, 0) AS n_orders,
       CASE WHEN oc.spend IS NULL THEN 'none' ELSE 'buyer' END AS kind,
       oc.o_custkey IS NULL AS no_orders
FROM customer c LEFT JOIN oc ON c.c_custkey = oc.o_custkey
""")
def _(spark, sf):
    t = T(spark, sf)
    oc = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("spend"))
    c = t.customer.select("c_custkey")
    j = c.join(oc, c.c_custkey == oc.o_custkey, "left_outer")
    return (j.na.fill(0, ["n_orders"])
             .withColumn("kind", F.when(F.col("spend").isNull(), "none").otherwise("buyer"))
             .withColumn("no_orders", F.col("o_custkey").isNull())
             .select("c_custkey", "n_orders", "kind", "no_orders"))


@query("drop_rows_with_nulls", "B14,C7", """
WITH s AS (SELECT s_nationkey AS nk, count(*) AS n_supp FROM supplier GROUP BY s_nationkey),
     c AS (SELECT c_nationkey AS nk, count(*) AS n_cust FROM customer WHERE c_acctbal > 9000 GROUP BY c_nationkey)
SELECT COALESCE(s.nk, c.nk) AS nk, s.n_supp, c.n_cust
FROM s FULL OUTER JOIN c ON s.nk = c.nk
WHERE s.n_supp IS NOT NULL AND c.n_cust IS NOT NULL
""")
def _(spark, sf):
    t = T(spark, sf)
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nk")).agg(F.count(F.lit(1)).alias("n_supp"))
    c = (t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nk"))
         .agg(F.count(F.lit(1)).alias("n_cust")))
    return s.join(c, "nk", "full_outer").na.drop(how="any")


@query("rename_and_drop_columns", "B18,B20,B28", """
SELECT n_nationkey AS nation_id, n_name AS nation, n_name AS nation_copy FROM nation
""")
def _(spark, sf):
    n = T(spark, sf).nation
    return (R.rename_columns(n, {"n_nationkey": "nation_id", "n_name": "nation"})
             .withColumn("nation_copy", F.col("nation")).drop("n_regionkey"))


@query("self_join_aliases_theta", "B19,B22,C12", """
SELECT a.c_custkey AS a_key, b.c_custkey AS b_key,
       round(a.c_acctbal - b.c_acctbal, 2) AS diff
FROM customer a JOIN customer b ON a.c_custkey = b.c_custkey + 1
WHERE a.c_acctbal > b.c_acctbal AND a.c_nationkey = b.c_nationkey
""")
def _(spark, sf):
    c = T(spark, sf).customer.select("c_custkey", "c_acctbal", "c_nationkey")
    a, b = R.prefix_columns(c, "a_"), R.prefix_columns(c, "b_")
    j = a.alias("a").join(b.alias("b"), (F.col("a.a_c_custkey") == F.col("b.b_c_custkey") + 1)
                          & (F.col("a.a_c_nationkey") == F.col("b.b_c_nationkey")))
    return (j.where(F.col("a.a_c_acctbal") > F.col("b.b_c_acctbal"))
             .select(F.col("a_c_custkey").alias("a_key"), F.col("b_c_custkey").alias("b_key"),
                     F.round(F.col("a_c_acctbal") - F.col("b_c_acctbal"), 2).alias("diff")))


@query("key_by_keys_values", "B23,B24", """
SELECT s_nationkey AS key, s_suppkey AS value_suppkey FROM supplier
""")
def _(spark, sf):
    s = T(spark, sf).supplier
    kv = R.key_by(s, F.col("s_nationkey"))
    return kv.select("key", F.col("value.s_suppkey").alias("value_suppkey"))


@query("parameterised_sql_args", "B25,B26,A21", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 3 AND o_orderstatus = 'O'
""")
def _(spark, sf):
    T(spark, sf).orders.createOrReplaceTempView("orders_v")
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM orders_v "
        "WHERE year(o_orderdate) = :y AND month(o_orderdate) = :m AND o_orderstatus = :st",
        args={"y": 1996, "m": 3, "st": "O"})


@query("parse_good_bad_split", "B29,H14", """
SELECT ok, count(*) AS n FROM (
  SELECT regexp_matches(props, '^\\{"k": [0-9]+\\}$') AND value >= 0 AS ok FROM events)
GROUP BY ok
""")
def _(spark, sf):
    e = T(spark, sf).events
    flagged, good, bad = R.split_good_bad(e, F.col("props").rlike(r'^\{"k": [0-9]+\}$') & (F.col("value") >= 0))
    return flagged.groupBy("ok").agg(F.count(F.lit(1)).alias("n"))


@query("unique_row_ids", "B30", """
SELECT count(*) AS n_rows, count(*) AS n_ids FROM orders
""")
def _(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey").withColumn("rid", F.monotonically_increasing_id())
    return o.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("rid").alias("n_ids"))


@query("derived_table_subquery_sql", "B31,A21", """
SELECT o_orderpriority, count(*) AS n_big
FROM (SELECT o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus <> 'P') q
WHERE o_totalprice > 250000
GROUP BY o_orderpriority
""")
def _(spark, sf):
    T(spark, sf).orders.createOrReplaceTempView("orders_v")
    return spark.sql("""
        SELECT o_orderpriority, count(*) AS n_big
        FROM (SELECT o_orderpriority, o_totalprice FROM orders_v WHERE o_orderstatus <> 'P') q
        WHERE o_totalprice > 250000 GROUP BY o_orderpriority""")


@query("order_by_hidden_expression_topk", "B32,F4,F6,F7", """
SELECT o_orderkey FROM orders
ORDER BY o_totalprice / (1 + o_custkey) DESC, o_orderkey LIMIT 25
""")
def _(spark, sf):
    o = T(spark, sf).orders
    return (R.top_k(o, 25, (F.col("o_totalprice") / (1 + F.col("o_custkey"))).desc(), F.col("o_orderkey"))
             .select("o_orderkey"))


# ---------------------------------------------------------------- 2.C ----

@query("join_inner_one_key", "C1,C13", """
SELECT o.o_orderkey, count(*) AS n_lines, round(sum(l.l_extendedprice), 2) AS gross
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderkey
""")
def _(spark, sf):
    t = T(spark, sf)
    o = t.orders.select(F.col("o_orderkey").alias("orderkey"))
    li = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_extendedprice")
    return (o.join(li, "orderkey").groupBy(F.col("orderkey").alias("o_orderkey"))
             .agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("gross")))


@query("join_inner_many_keys", "C2", """
WITH a AS (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
     b AS (SELECT l_suppkey, l_returnflag, max(l_extendedprice) AS top_price FROM lineitem
           WHERE l_linestatus = 'F' GROUP BY 1, 2)
SELECT a.l_suppkey, a.l_returnflag, a.qty, b.top_price
FROM a JOIN b ON a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    a = li.groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("qty"))
    b = (li.where("l_linestatus = 'F'").groupBy("l_suppkey", "l_returnflag")
           .agg(F.max("l_extendedprice").alias("top_price")))
    return a.join(b, ["l_suppkey", "l_returnflag"])


@query("join_on_expression", "C3", """
SELECT o.o_orderkey, c.c_custkey, o.o_totalprice, c.c_acctbal
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey AND o.o_totalprice > c.c_acctbal * 60
""")
def _(spark, sf):
    t = T(spark, sf)
    o, c = t.orders, t.customer
    return (o.join(c, (o.o_custkey == c.c_custkey) & (o.o_totalprice > c.c_acctbal * 60), "inner")
             .select("o_orderkey", "c_custkey", "o_totalprice", "c_acctbal"))


@query("join_on_computed_keys", "C4,H7", """
SELECT c.c_custkey, n.n_name
FROM customer c JOIN nation n ON upper(concat('nation_', CAST(c.c_nationkey AS VARCHAR))) = upper(n.n_name)
""")
def _(spark, sf):
    t = T(spark, sf)
    c, n = t.customer, t.nation
    key = F.upper(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")))
    return J.join_on_computed_keys(c, n, [(key, F.upper(n.n_name))]).select("c_custkey", "n_name")


@query("join_right_outer", "C6", """
WITH big AS (SELECT o_custkey, count(*) AS n_big FROM orders WHERE o_totalprice > 300000 GROUP BY o_custkey)
SELECT c.c_custkey, COALESCE(big.n_big, 0) AS n_big
FROM big RIGHT OUTER JOIN customer c ON big.o_custkey = c.c_custkey
""")
def _(spark, sf):
    t = T(spark, sf)
    big = t.orders.where("o_totalprice > 300000").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_big"))
    c = t.customer.select("c_custkey")
    return (big.join(c, big.o_custkey == c.c_custkey, "right_outer")
               .select("c_custkey", F.coalesce("n_big", F.lit(0)).alias("n_big")))


@query("join_left_semi", "C8", """
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
""")
def _(spark, sf):
    t = T(spark, sf)
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(big, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("join_left_anti", "C9,C10,G3", """
SELECT c_custkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
""")
def _(spark, sf):
    t = T(spark, sf)
    return t.customer.select("c_custkey").join(
        t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("cross_join_bounded_dimensions", "C11", """
SELECT r.r_name, p.o_orderpriority
FROM region r CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p
""")
def _(spark, sf):
    t = T(spark, sf)
    pri = t.orders.select("o_orderpriority").distinct()
    return R.cross_join_bounded(t.region.select("r_name"), pri)


@query("broadcast_lookup_with_default", "C14", """
SELECT c.c_custkey, COALESCE(m.n_regionkey + 100, c.c_nationkey) AS mapped_key
FROM customer c LEFT JOIN (SELECT n_nationkey, n_regionkey FROM nation WHERE n_regionkey = 1) m
  ON c.c_nationkey = m.n_nationkey
""")
def _(spark, sf):
    t = T(spark, sf)
    alias = t.nation.where("n_regionkey = 1").select("n_nationkey", (F.col("n_regionkey") + 100).alias("target"))
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("mapped_key"))
    return J.lookup_with_default(c, "mapped_key", alias, "n_nationkey", "target")


@query("broadcast_flag_semi_join", "C15", """
SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
""")
def _(spark, sf):
    t = T(spark, sf)
    flags = t.nation.where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"))
    return t.supplier.join(flags, "s_nationkey", "left_semi").select("s_suppkey")


@query("asof_join_backward", "C16", """
SELECT c.event_id, c.user_id, strftime(c.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       p.value AS last_purchase_value, COALESCE(p.event_id, -1) AS last_purchase_id
FROM (SELECT * FROM events WHERE event_type = 'click') c
ASOF LEFT JOIN (SELECT user_id, ts, value, event_id FROM events WHERE event_type = 'purchase'
                QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY value DESC NULLS LAST, event_id DESC) = 1) p
  ON c.user_id = p.user_id AND c.ts >= p.ts
""")
def _(spark, sf):
    e = T(spark, sf).events
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    buys = e.where("event_type = 'purchase'").select(
        "user_id", "ts", F.col("value").alias("last_purchase_value"), F.col("event_id").alias("last_purchase_id"))
    out = J.asof_join_backward(clicks, buys, ["user_id"], "ts", ["last_purchase_value", "last_purchase_id"])
    return (out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
               .withColumn("last_purchase_id", F.coalesce("last_purchase_id", F.lit(-1))))


@query("zip_by_position", "C20", """
WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos FROM orders),
     b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS pos FROM customer)
SELECT a.pos, a.o_orderkey, b.c_custkey FROM a JOIN b ON a.pos = b.pos
""")
def _(spark, sf):
    t = T(spark, sf)
    a = J.zip_with_index(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])
    b = J.zip_with_index(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"])
    return a.join(b, "pos").select("pos", "o_orderkey", "c_custkey")


# ---------------------------------------------------------------- 2.F ----

@query("sort_multi_key_mixed", "F1,F2,F3", """
SELECT c_mktsegment, c_acctbal, c_custkey FROM customer
""", note="order is not part of the oracle compare; plan shows a range-partitioned sort")
def _(spark, sf):
    c = T(spark, sf).customer
    return c.select("c_mktsegment", "c_acctbal", "c_custkey").orderBy(
        "c_mktsegment", F.desc("c_acctbal"), F.asc("c_custkey"))


@query("take_first_rows", "F5,A39", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5
""")
def _(spark, sf):
    return R.top_k(T(spark, sf).orders.select("o_orderkey", "o_totalprice"), 5, F.col("o_orderkey"))


@query("kth_largest_threshold", "F8", """
SELECT min(o_totalprice) AS kth FROM (SELECT o_totalprice FROM orders ORDER BY o_totalprice DESC LIMIT 100)
""")
def _(spark, sf):
    return R.kth_largest(T(spark, sf).orders, "o_totalprice", 100)


@query("sample_bernoulli_seeded", "F9", note="rows-only: Spark's seeded Bernoulli sample has no SQL twin")
def _(spark, sf):
    return T(spark, sf).orders.select("o_orderkey").sample(withReplacement=False, fraction=0.1, seed=7)


@query("random_split_by_hash", "F10", note="rows-only: xxhash64 split has no DuckDB twin")
def _(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey")
    return R.random_split_exact(o, [0.8, 0.2], ["o_orderkey"]).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("fixed_size_sample_per_group", "A38", """
SELECT o_orderpriority, count(*) AS n FROM (
  SELECT o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders)
WHERE rn <= 50 GROUP BY o_orderpriority
""")
def _(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey", "o_orderpriority")
    s = R.fixed_size_sample_per_group(o, F.col("o_orderpriority"), 50, key_cols=["o_orderkey"])
    return s.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("fixed_size_sample_rows", "A38", """
SELECT o_orderpriority, o_orderkey FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderpriority
    ORDER BY ('0x' || substr(md5(o_orderkey || ':7'), 1, 8))::BIGINT, o_orderkey) <= 50
""")
def _(spark, sf):
    o = T(spark, sf).orders.select("o_orderkey", "o_orderpriority")
    return R.fixed_size_sample_per_group(o, F.col("o_orderpriority"), 50, key_cols=["o_orderkey"])


@query("random_split_rows", "F10", """
SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT < floor(0.7 * 4294967296) THEN 0
    WHEN ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT < floor(0.9 * 4294967296) THEN 1 ELSE 2 END AS split FROM orders
""")
def _(spark, sf):
    return R.random_split_hashed(T(spark, sf).orders.select("o_orderkey"), [0.7, 0.2, 0.1], ["o_orderkey"])


@query("sample_with_replacement_rows", "F9", f"""
WITH d AS (SELECT o_orderkey, ('0x' || substr(md5(o_orderkey || ':11'), 1, 8))::BIGINT / 4294967296 AS u FROM orders),
c AS (SELECT o_orderkey, len(list_filter([{", ".join(f"{b!r}::DOUBLE" for b in R.poisson_bounds(0.5))}], lambda b: b <= u)) AS n FROM d)
SELECT o_orderkey, n::INTEGER AS copies FROM c WHERE n > 0
""", note="copies of a row by the Poisson law of mean 0.5")
def _(spark, sf):
    s = R.poisson_copies(T(spark, sf).orders.select("o_orderkey"), 0.5, ["o_orderkey"], 11)
    return s.groupBy("o_orderkey").agg(F.count(F.lit(1)).cast("int").alias("copies"))


@query("coalesce_and_partition_sizes", "F12,F13,F14", """
SELECT count(*) AS total_rows FROM lineitem
""")
def _(spark, sf):
    li = T(spark, sf).lineitem.select("l_orderkey").coalesce(4)
    return R.partition_sizes(li).agg(F.sum("rows").alias("total_rows"))


@query("map_partitions_arrow", "F15,K9", """
SELECT count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem WHERE l_quantity >= 10
""")
def _(spark, sf):
    from ..functions import udfs
    li = T(spark, sf).lineitem.select("l_quantity")
    return udfs.filter_batches(li, "l_quantity", 10.0).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("custom_partitioner_by_rule", "F16", """
SELECT CASE WHEN c_mktsegment < 'H' THEN 0 ELSE 1 END AS partition, count(*) AS n
FROM customer GROUP BY 1
""")
def _(spark, sf):
    c = T(spark, sf).customer
    rule = F.when(F.col("c_mktsegment") < "H", 0).otherwise(1)
    p = R.partition_by_rule(c, rule, 2)
    return p.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- 2.G ----

@query("union_all_keeps_duplicates", "G1", """
SELECT n, count(*) AS copies FROM (
  SELECT n_nationkey AS n FROM nation UNION ALL SELECT s_nationkey AS n FROM supplier)
GROUP BY n
""")
def _(spark, sf):
    t = T(spark, sf)
    u = t.nation.select(F.col("n_nationkey").alias("n")).unionByName(t.supplier.select(F.col("s_nationkey").alias("n")))
    return u.groupBy("n").agg(F.count(F.lit(1)).alias("copies"))


@query("distinct_rows", "D20,G2", """
SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_quantity AS BIGINT) AS q FROM lineitem
""")
def _(spark, sf):
    li = T(spark, sf).lineitem
    return li.select("l_returnflag", "l_linestatus", F.col("l_quantity").cast("bigint").alias("q")).distinct()


@query("intersect_except", "G4", """
SELECT 'both' AS kind, k FROM (SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 5000)
UNION ALL
SELECT 'only_orders' AS kind, k FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 5000)
""")
def _(spark, sf):
    t = T(spark, sf)
    a = t.orders.select(F.col("o_custkey").alias("k"))
    b = t.customer.where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"))
    return (a.intersect(b).select(F.lit("both").alias("kind"), "k")
             .unionByName(a.subtract(b).select(F.lit("only_orders").alias("kind"), "k")))


# ------------------------------------------------------ in-memory / plan ----

@query("in_memory_sources_bounded", "A1,A2,A3,A4,A40", """
SELECT r.r_regionkey AS key, r.r_name AS name, n.names, 1 AS one
FROM region r JOIN (SELECT n_regionkey, '{' || string_agg('"' || CAST(n_nationkey AS VARCHAR) || '":"' || n_name || '"', ',' ORDER BY n_nationkey) || '}' AS names
                    FROM nation GROUP BY n_regionkey) n ON r.r_regionkey = n.n_regionkey
""", note="only the 5-row region dimension crosses the driver (pandas round trip)")
def _(spark, sf):
    t = T(spark, sf)
    pdf = t.region.toPandas()                                   # A4: bounded dimension only
    r = spark.createDataFrame(pdf).toDF("key", "name")          # A2/A3
    one = spark.range(1, 2).select(F.col("id").cast("int").alias("one"))  # A1
    names = t.nation.groupBy("n_regionkey").agg(               # A40: collectAsMap as a map column
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("k"),
                                                                 F.col("n_name").alias("v"))))).alias("names"))
    out = r.join(names, r.key == names.n_regionkey).drop("n_regionkey").crossJoin(one)
    return out.withColumn("names", F.to_json("names")).select("key", "name", "names", "one")


@query("plan_pushdown_and_cache", "F18,F20", """
SELECT true AS pushed_filters, true AS pruned_schema, count(*) AS rows FROM lineitem WHERE l_quantity > 49
""")
def _(spark, sf):
    """A filtered, pruned scan: its plan is read, then it is cached and counted."""
    scan = T(spark, sf).lineitem.where(F.col("l_quantity") > 49).select("l_orderkey", "l_quantity")
    plan = R.plan_text(scan)
    pushed = F.regexp_like("plan", F.lit(r"PushedFilters: \[[^\]]*GreaterThan\(l_quantity,49"))
    pruned = F.regexp_like("plan", F.lit("ReadSchema: struct<l_orderkey:[a-z]+,l_quantity:[a-z]+>"))
    checks = written(plan.select(pushed.alias("pushed_filters"), pruned.alias("pruned_schema")), "plan-checks")
    cached = scan.cache()
    out = written(checks.crossJoin(cached.agg(F.count("l_quantity").alias("rows"))), "cached-count")
    cached.unpersist()
    return out


@query("foreach_side_effects", "F17,D41", """
SELECT count(*) AS rows_seen, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events
""")
def _(spark, sf):
    """Rows visited for their side effect alone: counters that every partition adds to."""
    rows, errors = R.foreach_counted(T(spark, sf).events.select("event_type"), lambda r: r.event_type == "error")
    return spark.range(1).select(F.lit(rows).alias("rows_seen"), F.lit(errors).alias("errors"))


@query("shuffle_width_setting", "F19,F13", """
SELECT 7 AS width, least(7, count(DISTINCT o_orderkey)) AS partitions, count(*) AS rows FROM orders
""")
def _(spark, sf):
    """The width set for one session, and the partitions that a shuffle then really has."""
    narrow = R.session_with_width(spark, 7)
    per = R.partition_sizes(T(narrow, sf).orders.groupBy("o_orderkey").count())
    return per.agg(F.lit(7).alias("width"), F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"))
