"""Catalogue: scalar functions — string, date, math, array, JSON
(SURVEY 2.H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as AR
from ..functions import dates as D
from ..functions import fixed
from ..functions.text import sql_tokens
from ..sources.tables import Tables
from .registry import query


def T(spark, sf):
    return Tables(spark, sf)


@query("array_item_by_position", "H2,I10", """
SELECT event_id, string_split(props, '"')[2] AS key_name,
       TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k_value,
       CAST(TRY_CAST(string_split(props, ' ')[5] AS BIGINT) AS VARCHAR) AS missing_field
FROM events
""")
def _(spark, sf):
    e = T(spark, sf).events
    parts = F.split("props", '"')
    return e.select("event_id", F.get(parts, 1).alias("key_name"),
                    F.regexp_extract("props", "([0-9]+)", 1).try_cast("bigint").alias("k_value"),
                    F.get(F.split("props", " "), 4).try_cast("bigint").cast("string").alias("missing_field"))


@query("string_times_number", "H41", """
SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS product FROM lineitem
""")
def _(spark, sf):
    """A number kept as text meets a number: the engine casts it."""
    li = T(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_quantity").cast("string").alias("q"))
    return li.select("l_orderkey", "l_linenumber", (F.col("q") * F.col("l_extendedprice")).alias("product"))


@query("regex_extract_and_replace", "H9,H12,H15", """
SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host,
       regexp_extract(url, '/([a-z]{2})/', 1) AS lang,
       replace(replace(url, '?', ''), '&', '') AS stripped,
       substring(url, 1, 10) AS prefix10
FROM pages
""")
def _(spark, sf):
    p = T(spark, sf).pages
    return p.select("page_id", F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("host"),
                    F.regexp_extract("url", r"/([a-z]{2})/", 1).alias("lang"),
                    F.translate("url", "?&", "").alias("stripped"), F.substring("url", 1, 10).alias("prefix10"))


@query("string_lengths_and_digits", "H13,H14", """
SELECT doc_id, length(text) AS n_chars_calc, n_chars,
       regexp_matches(source, '^src[0-9]+$') AS source_ok,
       TRY_CAST(regexp_extract(source, '[0-9]+$') AS INTEGER) AS source_no
FROM documents
""")
def _(spark, sf):
    d = T(spark, sf).documents
    return d.select("doc_id", F.length("text").alias("n_chars_calc"), "n_chars",
                    F.col("source").rlike(r"^src[0-9]+$").alias("source_ok"),
                    F.regexp_extract("source", r"[0-9]+$", 0).try_cast("int").alias("source_no"))


@query("month_name_dates_parsed", "H17,H19,H20,X6", """
SELECT o_orderkey, strftime(o_orderdate, '%d-%b-%Y') AS txt,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS parsed,
       CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(day(o_orderdate) AS INTEGER) AS d
FROM orders
""")
def _(spark, sf):
    o = T(spark, sf).orders
    txt = F.date_format("o_orderdate", "dd-MMM-yyyy")
    x = o.select("o_orderkey", txt.alias("txt"))
    parsed = D.parse_month_name_date(F.upper("txt"))  # upper-case month names parse too
    return x.select("o_orderkey", "txt", F.date_format(parsed, "yyyy-MM-dd").alias("parsed"),
                    F.year(parsed).alias("y"), F.month(parsed).alias("m"), F.dayofmonth(parsed).alias("d"))


@query("day_of_week_sunday_first", "H21", """
SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow FROM orders
""")
def _(spark, sf):
    return T(spark, sf).orders.select("o_orderkey", F.dayofweek("o_orderdate").alias("dow"))


@query("hour_and_day_of_event", "H22,H23", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hr, CAST(day(ts) AS INTEGER) AS dom, ts <= now() AS in_past FROM events
""")
def _(spark, sf):
    e = T(spark, sf).events
    return e.select("event_id", F.hour("ts").alias("hr"), F.dayofmonth("ts").alias("dom"),
                    (F.col("ts").cast("timestamp") <= F.current_timestamp()).alias("in_past"))


@query("calendar_validity", "H24", """
WITH c AS (SELECT y, m, d FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) ys,
           range(1, 13) ms(m), range(28, 32) ds(d))
SELECT y, CAST(m AS INTEGER) AS m, CAST(d AS INTEGER) AS d,
       TRY_CAST(printf('%04d-%02d-%02d', y, m, d) AS DATE) IS NOT NULL AS valid
FROM c
""")
def _(spark, sf):
    o = T(spark, sf).orders
    ys = o.select(F.year("o_orderdate").alias("y")).distinct()
    grid = (ys.withColumn("m", F.explode(F.sequence(F.lit(1), F.lit(12))))
              .withColumn("d", F.explode(F.sequence(F.lit(28), F.lit(31)))))
    return grid.select("y", "m", "d", D.is_valid_date("y", "m", "d").alias("valid"))


@query("price_bucket_floor_round", "H25,H26,H27,H42", """
SELECT p_partkey, CAST(floor(p_retailprice / 50) * 50 AS BIGINT) AS bucket,
       floor(sqrt(p_retailprice) * 10000 + 0.5) / 10000 AS root,
       floor(ln(p_retailprice) * 10000 + 0.5) / 10000 AS logp,
       CAST(pow(p_size, 2) AS BIGINT) AS size_sq,
       CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END AS parity
FROM part
""")
def _(spark, sf):
    p = T(spark, sf).part
    return p.select("p_partkey", (F.floor(F.col("p_retailprice") / 50) * 50).cast("bigint").alias("bucket"),
                    fixed(F.sqrt("p_retailprice"), 4).alias("root"), fixed(F.log("p_retailprice"), 4).alias("logp"),
                    F.pow("p_size", 2).cast("bigint").alias("size_sq"),
                    F.when(F.col("p_size") % 2 == 0, "even").otherwise("odd").alias("parity"))


@query("array_dot_and_distance", "H28,H29", """
WITH c AS (SELECT list_transform(range(1, 65), lambda i: 0.0) AS centre)
SELECT vec_id, floor(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) * 1e6 + 0.5) / 1e6 AS self_dot,
       floor(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) * 1e6 + 0.5) / 1e6 AS sq_dist_origin
FROM embeddings
""")
def _(spark, sf):
    e = T(spark, sf).embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    zero = F.array_repeat(F.lit(0.0), 64)
    return e.select("vec_id", fixed(AR.dot("v", "v"), 6).alias("self_dot"),
                    fixed(AR.squared_distance("v", zero), 6).alias("sq_dist_origin"))


@query("one_hot_to_index", "H30,L42", """
SELECT vec_id, label,
       list_position(list_transform(range(0, 5), lambda i: CASE WHEN i = label % 5 THEN 1.0 ELSE 0.0 END), 1.0) - 1 AS idx
FROM embeddings
""")
def _(spark, sf):
    e = T(spark, sf).embeddings
    onehot = F.transform(F.sequence(F.lit(0), F.lit(4)),
                         lambda i: F.when(i == F.col("label") % 5, F.lit(1.0)).otherwise(F.lit(0.0)))
    return e.select("vec_id", "label", AR.one_hot_index(onehot).cast("bigint").alias("idx"))


@query("json_get_object_and_from_json", "H34,H35,H36", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k_num,
       '{"id":' || CAST(event_id AS VARCHAR) || ',"type":"' || event_type || '"}' AS as_json
FROM events
""")
def _(spark, sf):
    e = T(spark, sf).events
    parsed = F.from_json("props", "k BIGINT")
    return e.select("event_id", F.get_json_object("props", "$.k").alias("k_text"),
                    parsed.getField("k").alias("k_num"),
                    F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("as_json"))


@query("explode_map_entries", "H4", """
SELECT event_id, 'k' AS key, CAST(json_extract(props, '$.k') AS BIGINT) AS value, event_type AS kind FROM events
""")
def _(spark, sf):
    e = T(spark, sf).events
    m = F.from_json("props", "map<string,bigint>")
    x = e.select("event_id", m.alias("m"), F.struct(F.col("event_type").alias("kind")).alias("info"))
    return x.select("event_id", F.explode("m").alias("key", "value"), F.col("info.kind").alias("kind"))


@query("term_frequency_per_row", "H39,H38", f"""
SELECT id, token, floor(count(*) / max(n) * 1e8 + 0.5) / 1e8 AS tf
FROM (SELECT item_id AS id, len(t) AS n, unnest(t) AS token
      FROM (SELECT item_id, {sql_tokens('text')} AS t FROM benchmark))
GROUP BY id, token
""")
def _(spark, sf):
    from ..functions.text import tokenize
    from ..jobs.entity import term_frequency
    b = T(spark, sf).benchmark.select(F.col("item_id").alias("id"), tokenize("text").alias("tokens"))
    return term_frequency(b).select("id", "token", fixed("tf", 8).alias("tf"))


@query("random_numbers_seeded", "H40", note="rows-only: Spark's rand(seed) has no DuckDB twin")
def _(spark, sf):
    c = T(spark, sf).customer.select("c_custkey")
    return c.select("c_custkey", F.rand(11).alias("u"), F.floor(F.rand(12) * 6).cast("int").alias("die"))


@query("prime_keys_distributed_sieve", "H43,C9", """
WITH m AS (SELECT max(o_orderkey) AS mx FROM orders),
c AS (SELECT DISTINCT unnest(generate_series(d * d, (SELECT mx FROM m), d)) AS n
      FROM range(2, CAST(floor(sqrt((SELECT mx FROM m))) AS BIGINT) + 1) t(d))
SELECT count(*) AS n_primes, CAST(sum(o_orderkey) AS BIGINT) AS sum_primes
FROM (SELECT DISTINCT o_orderkey FROM orders) o
WHERE o_orderkey >= 2 AND NOT EXISTS (SELECT 1 FROM c WHERE c.n = o.o_orderkey)
""")
def _(spark, sf):
    from ..operators.numeric import prime_flags
    keys = T(spark, sf).orders.select(F.col("o_orderkey").alias("n")).distinct()
    p = prime_flags(keys, "n").where("is_prime")
    return p.agg(F.count(F.lit(1)).alias("n_primes"), F.sum("n").cast("bigint").alias("sum_primes"))


@query("partition_values_from_file_paths", "H16,A13", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n
FROM orders GROUP BY 1, 2
""")
def _(spark, sf):
    from ..session import scratch_path
    o = T(spark, sf).orders.select("o_orderkey", F.year("o_orderdate").alias("year"),
                                   F.month("o_orderdate").alias("month"), F.lit(1).alias("day"))
    path = scratch_path(spark, "pathparts")
    o.write.partitionBy("year", "month", "day").parquet(path)
    files = spark.read.parquet(path).select("o_orderkey", F.input_file_name().alias("f"))
    y, m, _d = D.partition_values_from_path(F.col("f"))
    return files.groupBy(y.alias("year"), m.alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("nested_device_map_flatten", "H5,H32,H33,L44", """
SELECT c_custkey, c_mktsegment AS account_kind, CAST(c_nationkey AS VARCHAR) AS home_kind, 'account' AS device,
       c_mktsegment AS kind, CAST(unnest([c_custkey, c_nationkey]) AS BIGINT) AS port FROM customer
UNION ALL
SELECT c_custkey, c_mktsegment, CAST(c_nationkey AS VARCHAR), 'home', CAST(c_nationkey AS VARCHAR),
       CAST(c_nationkey AS BIGINT) FROM customer
""")
def _(spark, sf):
    """A map of structs, read from JSON text: looked up by key and by dot,
    then exploded twice in a row (entries, then the list inside each)."""
    def device(kind, *ports):
        return F.struct(F.struct(F.col(kind).cast("string").alias("kind")).alias("info"),
                        F.array(*[F.col(p).cast("bigint") for p in ports]).alias("ports"))

    text = F.to_json(F.create_map(F.lit("account"), device("c_mktsegment", "c_custkey", "c_nationkey"),
                                  F.lit("home"), device("c_nationkey", "c_nationkey")))
    c = T(spark, sf).customer.select("c_custkey", F.from_json(
        text, "map<string, struct<info: struct<kind: string>, ports: array<bigint>>>").alias("devices"))
    entries = c.select("c_custkey", F.col("devices")["account"]["info"]["kind"].alias("account_kind"),
                       F.col("devices.home.info.kind").alias("home_kind"), F.explode("devices").alias("device", "d"))
    return entries.select("c_custkey", "account_kind", "home_kind", "device", F.col("d.info.kind").alias("kind"),
                          F.explode("d.ports").alias("port"))
