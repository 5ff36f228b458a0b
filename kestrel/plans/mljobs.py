"""Catalogue: ML jobs on embeddings and lineitem.
Model outputs depend on MLlib's solvers, so most are rows-only; the class
distribution / random-guess accuracy is SQL-checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..ml import jobs as ML
from ..ml import recommender as REC
from ..session import written
from ..sources.tables import Tables
from .registry import query


def vectors(spark, sf):
    return ML.embedding_features(Tables(spark, sf).embeddings)


@query("kmeans_anomalies_top_distance", "L37,M1,M5,M6,M7,H29,F8", note="rows-only: k-means result")
def _(spark, sf):
    a = ML.anomalies(vectors(spark, sf), "features", k=8, top=20, max_iter=10)
    return a.select("vec_id", "label", "cluster", F.round("distance", 6).alias("distance"), "rank")


@query("kmeans_entropy_sweep", "L38,M8,M10,D38", note="rows-only: one row per k")
def _(spark, sf):
    return ML.entropy_sweep(vectors(spark, sf), "features", "label", [2, 4, 8], max_iter=5)


@query("class_distribution_random_guess", "L41,D37", """
WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
p AS (SELECT label, n, n / (SELECT count(*) FROM embeddings) AS p FROM c)
SELECT label, n, floor(p * 1e9 + 0.5) / 1e9 AS p, floor((SELECT sum(p * p) FROM p) * 1e9 + 0.5) / 1e9 AS random_guess
FROM p
""")
def _(spark, sf):
    e = Tables(spark, sf).embeddings
    dist = ML.class_distribution(e, "label")
    acc = ML.random_guess_accuracy(e, e, "label")
    return dist.crossJoin(acc).select("label", "n", fixed("p", 9).alias("p"), fixed("accuracy", 9).alias("random_guess"))


@query("kmeans_cost_sweep_variants", "M3,M5,M7,M9", note="rows-only: k-means costs")
def _(spark, sf):
    return ML.cost_sweep(vectors(spark, sf).withColumn("label", F.col("label").cast("string")), "features", "label", [2, 4, 8])


@query("random_guess_of_a_test_set", "L41", """
WITH p AS (SELECT vec_id % 5 = 0 AS test, label, count(*) AS n FROM embeddings GROUP BY ALL),
q AS (SELECT test, label, n / sum(n) OVER (PARTITION BY test) AS p FROM p)
SELECT floor(sum(a.p * b.p) * 1e9 + 0.5) / 1e9 AS accuracy FROM q a JOIN q b ON a.label = b.label AND NOT a.test AND b.test
""")
def _(spark, sf):
    e = Tables(spark, sf).embeddings
    acc = ML.random_guess_accuracy(e.where("vec_id % 5 <> 0"), e.where("vec_id % 5 = 0"), "label")
    return acc.select(fixed("accuracy", 9).alias("accuracy"))


@query("random_forest_tuned_confusion", "M18,M19", note="rows-only: confusion matrix rows")
def _(spark, sf):
    from pyspark.ml.feature import VectorIndexer
    v = vectors(spark, sf)
    v = VectorIndexer(inputCol="features", outputCol="ifeatures", maxCategories=4).fit(v).transform(v)
    model, tree, acc, f1, confusion = ML.tuned_forest(v, "ifeatures", "label")
    return confusion


@query("linear_regression_price", "M2,M3,M12,M13", note="rows-only: one metrics row")
def _(spark, sf):
    li = Tables(spark, sf).lineitem
    _, rmse, r2 = ML.linear_regression(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice",
                                       categorical=["l_returnflag", "l_linestatus"])
    return spark.createDataFrame([(float(rmse), float(r2))], "rmse double, r2 double")


_PLAYS_SQL = """
WITH lines AS (SELECT CASE WHEN p_partkey % 11 = 0 THEN p_name WHEN p_partkey % 13 = 0 THEN p_partkey || chr(9) || '  '
                           ELSE p_partkey || chr(9) || p_name END AS value FROM part),
named AS (SELECT TRY_CAST(string_split(value, chr(9))[1] AS BIGINT) AS id, trim(string_split(value, chr(9))[2]) AS name FROM lines),
names AS (SELECT id, name FROM named WHERE id IS NOT NULL AND name <> ''),
RECURSIVE_MARK
canon AS (SELECT id, target FROM chain c WHERE NOT EXISTS (SELECT 1 FROM alias a WHERE a.id = c.target)),
plays AS (SELECT o_custkey AS u, coalesce(target, l_partkey) AS item, CAST(sum(l_quantity) AS BIGINT) AS plays
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN canon ON canon.id = l_partkey GROUP BY 1, 2)
""".replace("WITH lines", "WITH RECURSIVE lines").replace("RECURSIVE_MARK", """
alias AS (SELECT p_partkey AS id, p_partkey // 3 AS target FROM part WHERE p_partkey % 5 = 0 AND p_partkey // 3 > 0),
chain AS (SELECT id, target FROM alias UNION SELECT c.id, a.target FROM chain c JOIN alias a ON a.id = c.target),""")


def name_lines(spark, sf):
    """Stand-in for the list of names, with lines that lack an id or a name."""
    key = F.col("p_partkey")
    tab = F.lit("\t")
    return Tables(spark, sf).part.select(F.when(key % 11 == 0, F.col("p_name"))
                                         .when(key % 13 == 0, F.concat(key.cast("string"), tab, F.lit("  ")))
                                         .otherwise(F.concat(key.cast("string"), tab, F.col("p_name"))).alias("value"))


def alias_lines(spark, sf):
    """Stand-in for the list of aliases: chains of several steps."""
    key = F.col("p_partkey")
    return Tables(spark, sf).part.where((key % 5 == 0) & (F.expr("p_partkey div 3") > 0)).select(
        F.concat(key.cast("string"), F.lit("\t"), F.expr("p_partkey div 3").cast("string")).alias("value"))


def plays(spark, sf):
    """(user, item, plays) with aliases resolved."""
    t = Tables(spark, sf)
    li, o = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), t.orders.select("o_orderkey", "o_custkey")
    raw = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), "l_quantity")
    canon = REC.resolve_aliases(REC.clean_aliases(alias_lines(spark, sf)))
    return REC.with_canonical(raw, "item", canon).groupBy("user", "item").agg(
        F.sum("l_quantity").cast("bigint").alias("plays"))


@query("recommender_names_and_aliases", "L39,C14,B29", _PLAYS_SQL + """
SELECT item, name, count(*) AS users, CAST(sum(plays) AS BIGINT) AS plays
FROM plays LEFT JOIN names ON names.id = plays.item GROUP BY 1, 2
""")
def _(spark, sf):
    names = REC.clean_names(name_lines(spark, sf)).withColumnRenamed("id", "item")
    return plays(spark, sf).join(names, "item", "left").groupBy("item", "name").agg(
        F.count(F.lit(1)).alias("users"), F.sum("plays").alias("plays"))


@query("recommender_negative_draws", "F11", _PLAYS_SQL + """,
idx AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS i FROM (SELECT DISTINCT item FROM plays)),
have AS (SELECT u, i, row_number() OVER (PARTITION BY u ORDER BY i) - 1 AS draw, count(*) OVER (PARTITION BY u) AS n
         FROM plays JOIN idx USING (item)),
r AS (SELECT u, draw, ('0x' || substr(md5(u || ':' || draw || ':5'), 1, 8))::BIGINT % ((SELECT count(*) FROM idx) - n) AS r
      FROM have WHERE (SELECT count(*) FROM idx) > n),
k AS (SELECT r.u, r.draw, r.r, count(h.i) AS skip FROM r LEFT JOIN have h ON h.u = r.u AND h.i - h.draw <= r.r GROUP BY 1, 2, 3)
SELECT k.u AS user, k.draw, idx.item FROM k JOIN idx ON idx.i = k.r + k.skip
""")
def _(spark, sf):
    p = plays(spark, sf)
    return REC.negative_draws(p, p, "user", "item")


@query("auc_of_stored_scores", "L40", """
WITH s AS (SELECT o_custkey AS u, l_discount AS score, l_returnflag = 'R' AS pos
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
a AS (SELECT p.u, count(*) FILTER (WHERE p.score > q.score) AS correct, count(*) AS pairs
      FROM s p JOIN s q ON p.u = q.u AND p.pos AND NOT q.pos GROUP BY 1)
SELECT u AS user, correct, floor(correct / pairs * 1e9 + 0.5) / 1e9 AS auc FROM a
""")
def _(spark, sf):
    t = Tables(spark, sf)
    s = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user"), F.col("l_discount").alias("score"), (F.col("l_returnflag") == "R").alias("pos"))
    return REC.auc_by_group(s, ["user"], "score", "pos").select(
        "user", F.col("correct").cast("bigint").alias("correct"), fixed("auc", 9).alias("auc"))


@query("als_recommend_and_auc", "L39,M11,F6", note="rows-only: ALS factors are solver-dependent")
def _(spark, sf):
    """Top five of the users whose id 20 divides, with names, and the users who suit
    the items whose id 20 divides, each with its score."""
    names = REC.clean_names(name_lines(spark, sf))
    ratings = written(plays(spark, sf).select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), "plays"),
                      "plays")
    model = ML.als_implicit(ratings, "user", "item", "plays", rank=8, reg=0.01, max_iter=5)
    some = REC.top_items(model, ratings.select("user").distinct().where("user % 20 = 0"), 5, names)
    back = REC.top_users(model, ratings.select("item").distinct().where("item % 20 = 0"), 5)
    return some.select(F.lit("item for user").alias("kind"), "user", "item", "rank", "score", "name").unionByName(
        back.select(F.lit("user for item").alias("kind"), "user", "item", "rank", "score", F.lit(None).cast("string").alias("name")))


@query("als_sweep_by_auc", "L40,F11,M11", note="rows-only: ALS factors are solver-dependent")
def _(spark, sf):
    """Mean AUC on held-out positives over a grid, one negative per positive."""
    ratings = written(plays(spark, sf).select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), "plays"),
                      "plays")
    train, test = ML.hashed_split(ratings, ["user", "item"], 10)
    negatives = REC.negative_draws(ratings, ratings, "user", "item").select("user", "item")
    grid = [{"rank": r, "reg": g, "alpha": a} for r, g, a in ((4, 0.01, 1.0), (8, 0.01, 1.0), (4, 1.0, 40.0), (8, 1.0, 40.0))]
    return REC.auc_sweep(train, test, negatives, "user", "item", "plays", grid)


@query("forest_held_out_report", "M4,M14,M16,M17,M18,M19,M20", note="rows-only: MLlib models")
def _(spark, sf):
    li = Tables(spark, sf).lineitem
    return ML.forest_report(li, ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"], "l_returnflag",
                            ["l_orderkey", "l_linenumber"])


@query("regression_cross_validated", "M12,M13,M15,M20", note="rows-only: MLlib model")
def _(spark, sf):
    li = Tables(spark, sf).lineitem
    return ML.cross_validated_regression(li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice",
                                         ["l_orderkey", "l_linenumber"])


@query("ml_unit_deviation", "M1,M5,M6", """
WITH e AS (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[len(embedding)]::DOUBLE AS z FROM embeddings)
SELECT vec_id, floor(a / stddev_samp(a) OVER () * 1e6 + 0.5) / 1e6 AS first_slot,
       floor(z / stddev_samp(z) OVER () * 1e6 + 0.5) / 1e6 AS last_slot FROM e
""")
def _(spark, sf):
    s = ML.unit_deviation(vectors(spark, sf), "features", "s")
    return s.select("vec_id", fixed(F.element_at("s", 1), 6).alias("first_slot"), fixed(F.element_at("s", -1), 6).alias("last_slot"))


@query("ml_encoded_strings", "M2,M3,M6", """
WITH s AS (SELECT c_mktsegment AS v, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS i FROM customer GROUP BY 1),
f AS (SELECT c_nationkey AS v, row_number() OVER (ORDER BY count(*) DESC, CAST(c_nationkey AS VARCHAR)) - 1 AS i FROM customer GROUP BY 1)
SELECT c_custkey, s.i AS segment_index, f.i AS nation_index,
       array_to_string(list_transform(range((SELECT count(*) - 1 FROM s)), lambda k: (k = s.i)::INT), '') AS segment_slots,
       array_to_string(list_transform(range((SELECT count(*) - 1 FROM f)), lambda k: (k = f.i)::INT), '') AS nation_slots
FROM customer JOIN s ON s.v = c_mktsegment JOIN f ON f.v = c_nationkey
""")
def _(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", F.col("c_mktsegment").alias("segment"),
                                          F.col("c_nationkey").cast("string").alias("nation"))
    e = ML.encoded_strings(c, ["segment", "nation"])
    bits = {f"{n}_slots": F.array_join(F.transform(f"{n}_slots", lambda x: x.cast("int").cast("string")), "") for n in ("segment", "nation")}
    return e.withColumns(bits).select("c_custkey", F.col("segment_index").cast("bigint").alias("segment_index"),
                                      F.col("nation_index").cast("bigint").alias("nation_index"), "segment_slots", "nation_slots")


@query("ml_category_slots", "M1,M4", """
SELECT l_orderkey, l_linenumber, dense_rank() OVER (ORDER BY l_linenumber) - 1 AS line_slot, l_extendedprice AS price_slot FROM lineitem
""")
def _(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    s = ML.category_slots(li, ["l_linenumber", "l_extendedprice"], 20)
    return s.select("l_orderkey", "l_linenumber", F.get("slots", 0).cast("bigint").alias("line_slot"), F.get("slots", 1).alias("price_slot"))


@query("ml_least_squares", "M12", """
SELECT 'l_quantity' AS name, floor(regr_slope(l_extendedprice, l_quantity) * 1000 + 0.5) / 1000 AS value FROM lineitem
UNION ALL SELECT 'intercept', floor(regr_intercept(l_extendedprice, l_quantity) * 1000 + 0.5) / 1000 FROM lineitem
""")
def _(spark, sf):
    li = Tables(spark, sf).lineitem
    return ML.least_squares(li, ["l_quantity"], "l_extendedprice").select("name", fixed("value", 3).alias("value"))


@query("ml_regression_scores", "M13", """
WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1000 + 500 AS p FROM lineitem),
m AS (SELECT avg(y) AS m FROM p)
SELECT 'rmse' AS metric, floor(sqrt(avg((y - p) * (y - p))) * 1000 + 0.5) / 1000 AS value FROM p
UNION ALL SELECT 'mae', floor(avg(abs(y - p)) * 1000 + 0.5) / 1000 FROM p
UNION ALL SELECT 'r2', floor((1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m))) * 1000 + 0.5) / 1000 FROM p, m
""")
def _(spark, sf):
    li = Tables(spark, sf).lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1000 + 500).alias("p"))
    return ML.regression_scores(li, "y", "p").select("metric", fixed("value", 3).alias("value"))


@query("ml_classification_scores", "M17,M18", """
WITH t AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y,
                  CASE WHEN l_linestatus = 'O' THEN 1 WHEN l_quantity < 25 THEN 0 ELSE 2 END AS p FROM lineitem),
c AS (SELECT y, count(*) AS n, count(*) FILTER (WHERE y = p) AS hit FROM t GROUP BY y),
q AS (SELECT p, count(*) AS n FROM t GROUP BY p),
f AS (SELECT c.n, c.hit / c.n AS recall, c.hit / q.n AS precision FROM c JOIN q ON c.y = q.p)
SELECT 'accuracy' AS metric, floor(avg((y = p)::INT) * 1e6 + 0.5) / 1e6 AS value FROM t
UNION ALL SELECT 'f1', floor(sum(n * 2 * precision * recall / (precision + recall)) / (SELECT count(*) FROM t) * 1e6 + 0.5) / 1e6 FROM f
UNION ALL SELECT 'cell ' || y || ' as ' || p, count(*) FROM t GROUP BY y, p
""")
def _(spark, sf):
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    t = Tables(spark, sf).lineitem.select(
        F.when(flag == "A", 0.0).when(flag == "N", 1.0).otherwise(2.0).alias("y"),
        F.when(line == "O", 1.0).when(F.col("l_quantity") < 25, 0.0).otherwise(2.0).alias("p"))
    return ML.classification_scores(t, "y", "p").select("metric", fixed("value", 6).alias("value"))
