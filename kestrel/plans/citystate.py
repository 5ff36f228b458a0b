"""Catalogue: document-store style reports and
nested data / JSON round trips (L43-L46, H31-H37) on the driver tables.

City/state stand-in: state = nation name, city = market segment,
population = account balance (customer ⋈ nation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.aggregate import extreme_by
from ..sources.tables import Tables
from .registry import query

_CITY = """
WITH city AS (SELECT n.n_name AS state, c.c_mktsegment AS city, sum(c.c_acctbal) AS pop
              FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2)
"""


def cities(spark, sf):
    t = Tables(spark, sf)
    c, n = t.customer, t.nation
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy(F.col("n_name").alias("state"), F.col("c_mktsegment").alias("city")).agg(
        F.sum("c_acctbal").alias("pop"))


@query("state_population_threshold", "L21,D14,D32,A29", _CITY + """
SELECT state, floor(sum(pop) * 100 + 0.5) / 100 AS total_pop FROM city GROUP BY state HAVING sum(pop) > 250000
""")
def _(spark, sf):
    s = cities(spark, sf).groupBy("state").agg(F.sum("pop").alias("total_pop")).where("total_pop > 250000")
    return s.select("state", fixed("total_pop", 2).alias("total_pop"))


@query("state_average_city_population", "L22,D30", _CITY + """
SELECT state, floor(avg(pop) * 100 + 0.5) / 100 AS avg_city_pop FROM city GROUP BY state
""")
def _(spark, sf):
    s = cities(spark, sf).groupBy("state").agg(F.avg("pop").alias("avg_city_pop"))
    return s.select("state", fixed("avg_city_pop", 2).alias("avg_city_pop")).orderBy("avg_city_pop")


@query("largest_smallest_city_per_state", "L23,L25,D31,A29", _CITY + """
SELECT state, arg_min(city, (-pop, city)) AS biggest_city, floor(max(pop) * 100 + 0.5) / 100 AS biggest_pop,
       arg_min(city, (pop, city)) AS smallest_city, floor(min(pop) * 100 + 0.5) / 100 AS smallest_pop
FROM city GROUP BY state
""")
def _(spark, sf):
    e = extreme_by(cities(spark, sf), ["state"], "pop", "city", "city")
    doc = e.select("state", F.struct(F.col("biggest_city").alias("name"), F.col("biggest_pop").alias("pop")).alias("biggestCity"),
                   F.struct(F.col("smallest_city").alias("name"), F.col("smallest_pop").alias("pop")).alias("smallestCity"))
    return doc.select("state", F.col("biggestCity.name").alias("biggest_city"),
                      fixed("biggestCity.pop", 2).alias("biggest_pop"),
                      F.col("smallestCity.name").alias("smallest_city"), fixed("smallestCity.pop", 2).alias("smallest_pop"))


@query("match_filter_documents", "L24,B3", """
SELECT doc_id, lang, source FROM documents WHERE lang = 'fr' AND n_chars > 1000
""")
def _(spark, sf):
    d = Tables(spark, sf).documents
    return d.where((F.col("lang") == "fr") & (F.col("n_chars") > 1000)).select("doc_id", "lang", "source")


# ------------------------------------------------------------ nested ----

@query("sensor_json_filter_roundtrip", "L43,H34,H35,H36,H37,A9", """
SELECT event_id, '{"device":' || CAST(user_id AS VARCHAR) || ',"k":' || json_extract_string(props, '$.k') || '}' AS out_json
FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) < 20
""")
def _(spark, sf):
    e = Tables(spark, sf).events
    s = e.select("event_id", F.struct(F.col("user_id").alias("device"),
                                      F.from_json("props", "k BIGINT").alias("p")).alias("rec"))
    f = s.where(F.col("rec.p.k") < 20)
    return f.select("event_id", F.to_json(F.struct(F.col("rec.device").alias("device"),
                                                   F.col("rec.p.k").alias("k"))).alias("out_json"))


_ORDER_DOC = """
WITH docs AS (
  SELECT o.o_orderkey, c.c_mktsegment AS segment, c.c_nationkey AS nation, l.l_partkey, l.l_quantity
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey)
"""


def order_documents(spark, sf):
    """Nested order documents: customer struct + array of line structs.
    Lines per order are bounded by the order (TPC-H: ≤ 7)."""
    t = Tables(spark, sf)
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.col("l_partkey").alias("part"), F.col("l_quantity").alias("qty"))).alias("lines"))
    orders, cust = t.orders, t.customer
    o = orders.join(cust, orders.o_custkey == cust.c_custkey)
    o = o.select("o_orderkey", F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                                        F.col("c_nationkey").alias("nation")).alias("customer"))
    return o.join(lines, o.o_orderkey == lines.l_orderkey).drop("l_orderkey")


@query("nested_documents_group_flatten", "L45,L46,D29,H3,H31,H36,H35", _ORDER_DOC + """
SELECT segment, CAST(sum(l_quantity) AS BIGINT) AS qty, count(DISTINCT o_orderkey) AS n_orders FROM docs GROUP BY segment
""")
def _(spark, sf):
    d = order_documents(spark, sf)
    rt = d.select(F.to_json(F.struct("*")).alias("j")).select(F.from_json("j", d.schema).alias("d")).select("d.*")
    flat = rt.select("o_orderkey", "customer.segment", F.explode("lines").alias("line"))
    return flat.groupBy("segment").agg(F.sum("line.qty").cast("bigint").alias("qty"),
                                       F.count_distinct("o_orderkey").alias("n_orders"))


@query("nested_path_filter_select", "L46,H31,H37", _ORDER_DOC + """
SELECT o_orderkey, segment, nation, count(*) AS n_lines FROM docs WHERE nation = 7 GROUP BY 1, 2, 3
""")
def _(spark, sf):
    d = order_documents(spark, sf).where(F.col("customer.nation") == 7)
    return d.select("o_orderkey", "customer.segment", "customer.nation", F.size("lines").alias("n_lines"))
