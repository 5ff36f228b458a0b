"""Catalogue: word counts and entity resolution over whole texts
(SURVEY L26, L27, L30-L36, H10-H13, H38, H39, C19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import simple_tokenize, sql_tokens
from ..jobs import entity as E
from ..session import written
from ..sources.tables import Tables, spread
from .registry import query

_WORDS = f"WITH w AS (SELECT unnest({sql_tokens('text', drop_stop=False)}) AS word FROM documents)\n"


def words(spark, sf):
    texts = spread(Tables(spark, sf).documents.select("text"))
    return texts.select(F.explode(simple_tokenize("text")).alias("word"))


@query("word_count_documents", "L26,H3,H10,D10", _WORDS + """
SELECT word, count(*) AS count FROM w GROUP BY word
""")
def _(spark, sf):
    return words(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


@query("word_count_top20_sql", "L26,F6", _WORDS + """
SELECT word, count(*) AS count FROM w GROUP BY word ORDER BY count DESC, word LIMIT 20
""")
def _(spark, sf):
    words(spark, sf).createOrReplaceTempView("doc_words")
    return spark.sql("SELECT word, count(*) AS count FROM doc_words GROUP BY word "
                     "ORDER BY count DESC, word LIMIT 20")


@query("long_words_stats", "L27,H13", _WORDS + """
SELECT word, count(*) AS count, CAST(length(word) * count(*) AS BIGINT) AS weighted_length
FROM w WHERE length(word) > 10 GROUP BY word
""")
def _(spark, sf):
    w = words(spark, sf).where(F.length("word") > 10)
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("count")).withColumn(
        "weighted_length", (F.length("word") * F.col("count")).cast("bigint"))


@query("long_words_top10_total", "L27,F6", _WORDS + """
SELECT CAST(sum(count) AS BIGINT) AS top10_total FROM (
  SELECT word, count(*) AS count FROM w WHERE length(word) > 10 GROUP BY word ORDER BY count DESC, word LIMIT 10)
""")
def _(spark, sf):
    w = words(spark, sf).where(F.length("word") > 10)
    top = w.groupBy("word").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "word").limit(10)
    return top.agg(F.sum("count").cast("bigint").alias("top10_total"))


# ------------------------------------------------------------- ER -------

_REC = f"""
WITH rec AS (
  SELECT 'doc' AS source, doc_id AS id, {sql_tokens('text')} AS tokens FROM documents
  UNION ALL
  SELECT 'item' AS source, item_id AS id, {sql_tokens('text')} AS tokens FROM benchmark),
tf AS (SELECT source, id, token, count(*) / max(n) AS tf
       FROM (SELECT source, id, len(tokens) AS n, unnest(tokens) AS token FROM rec) GROUP BY source, id, token),
idf AS (SELECT token, count(*) AS n_records, (SELECT count(*) FROM rec) / count(*) AS idf
        FROM (SELECT DISTINCT source, id, unnest(tokens) AS token FROM rec) GROUP BY token),
w AS (SELECT tf.source, tf.id, tf.token, tf.tf * idf.idf AS weight FROM tf JOIN idf ON tf.token = idf.token),
nrm AS (SELECT source, id, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY source, id),
all_sims AS (
  SELECT a.id AS doc_id, b.id AS item_id, sum(a.weight * b.weight) / (na.norm * nb.norm) AS sim
  FROM w a JOIN w b ON a.token = b.token AND a.source = 'doc' AND b.source = 'item'
  JOIN nrm na ON na.source = 'doc' AND na.id = a.id
  JOIN nrm nb ON nb.source = 'item' AND nb.id = b.id
  GROUP BY a.id, b.id, na.norm, nb.norm),
sims AS (SELECT * FROM all_sims WHERE floor(sim * 1000000 + 0.5) / 1000000 >= 0.1),
gold AS (SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text))
"""
# the same with every pair of a common token in ``sims``
_SIMS = _REC.replace(
    "sims AS (SELECT * FROM all_sims WHERE floor(sim * 1000000 + 0.5) / 1000000 >= 0.1),\n", "").replace("all_sims", "sims")


def corpus(spark, sf):
    t = Tables(spark, sf)
    docs = E.record_tokens(spread(t.documents.select("doc_id", "text")), "doc_id", "text", source="doc")
    items = E.record_tokens(t.benchmark, "item_id", "text", source="item")
    return docs.unionByName(items)


def weights(spark, sf):
    rec = corpus(spark, sf)
    keys = ("source", "id")
    return E.tfidf(E.term_frequency(rec, keys), E.inverse_document_frequency(rec, keys))


def similarities(spark, sf):
    """Every pair of a document and an item that share a token."""
    return E.all_similarities(corpus(spark, sf), "doc", "item", "doc_id", "item_id")


def gold(spark, sf):
    t = Tables(spark, sf)
    docs = spread(t.documents.select("doc_id", "text"))
    return E.containment_pairs(docs, "doc_id", "text", t.benchmark, "item_id", "text")


@query("er_token_counts", "L30,H10,H11,H13", _REC + """
SELECT source, id, len(tokens) AS n_tokens FROM rec
""")
def _(spark, sf):
    return E.token_counts(corpus(spark, sf)).select("source", "id", F.col("n_tokens").cast("bigint").alias("n_tokens"))


@query("er_total_tokens_biggest_record", "L30,F6", _REC + """
SELECT (SELECT CAST(sum(len(tokens)) AS BIGINT) FROM rec) AS total_tokens,
       (SELECT id FROM rec WHERE source = 'doc' ORDER BY len(tokens) DESC, id LIMIT 1) AS biggest_doc
""")
def _(spark, sf):
    c = E.token_counts(corpus(spark, sf))
    total = c.agg(F.sum("n_tokens").cast("bigint").alias("total_tokens"))
    big = (c.where("source = 'doc'").orderBy(F.desc("n_tokens"), "id").limit(1)
            .select(F.col("id").alias("biggest_doc")))
    return total.crossJoin(big)


@query("er_idf_weights", "L31,H38,D10", _REC + """
SELECT token, n_records, floor(idf * 1000000 + 0.5) / 1000000 AS idf FROM idf
""")
def _(spark, sf):
    rec = corpus(spark, sf)
    i = E.inverse_document_frequency(rec, ("source", "id"))
    return i.select("token", "n_records", fixed("idf", 6).alias("idf"))


@query("er_idf_smallest", "L31,F7", _REC + """
SELECT token, floor(idf * 1000000 + 0.5) / 1000000 AS idf FROM idf ORDER BY idf, token LIMIT 11
""")
def _(spark, sf):
    i = E.inverse_document_frequency(corpus(spark, sf), ("source", "id"))
    return i.orderBy("idf", "token").limit(11).select("token", fixed("idf", 6).alias("idf"))


@query("er_idf_histogram", "L31,D35", _REC + """
SELECT g.bucket, COALESCE(c.count, 0) AS count
FROM (SELECT unnest(range(0, 4))::INTEGER AS bucket) g LEFT JOIN (
  SELECT CASE WHEN idf >= 0 AND idf < 10 THEN 0 WHEN idf >= 10 AND idf < 100 THEN 1
              WHEN idf >= 100 AND idf < 1000 THEN 2 WHEN idf >= 1000 THEN 3 END AS bucket,
         count(*) AS count FROM idf GROUP BY 1) c ON g.bucket = c.bucket
""")
def _(spark, sf):
    from ..operators.aggregate import histogram_bounds
    i = E.inverse_document_frequency(corpus(spark, sf), ("source", "id"))
    return histogram_bounds(i, "idf", [0, 10, 100, 1000, float("inf")]).select("bucket", "count")


@query("er_tfidf_item_weights", "L32,H39", _REC + """
SELECT id AS item_id, token, floor(weight * 1000000 + 0.5) / 1000000 AS weight FROM w WHERE source = 'item'
""")
def _(spark, sf):
    w = weights(spark, sf).where("source = 'item'")
    return w.select(F.col("id").alias("item_id"), "token", fixed("weight", 6).alias("weight"))


@query("er_cosine_similarity_pairs", "L33,L34,C19,H27", _SIMS + """
SELECT doc_id, item_id, floor(sim * 1000000 + 0.5) / 1000000 AS sim FROM sims
""")
def _(spark, sf):
    return similarities(spark, sf).select("doc_id", "item_id", fixed("sim", 6).alias("sim"))


@query("er_gold_containment_pairs", "L35,C9", _REC + """
SELECT doc_id, item_id FROM gold
""")
def _(spark, sf):
    return gold(spark, sf)


_SHORT_ITEMS = """
WITH items AS (SELECT item_id, substr(text, 1 + item_id % 7, 1 + item_id % 45) AS part FROM benchmark)
SELECT d.doc_id, i.item_id FROM documents d JOIN items i ON contains(d.text, i.part) WHERE i.part <> ''
"""


@query("er_containment_of_short_parts", "L35,C9", _SHORT_ITEMS)
def _(spark, sf):
    """Parts of 1 to 45 characters, cut anywhere, so that they begin and end inside words."""
    t = Tables(spark, sf)
    items = t.benchmark.select("item_id", F.expr("substr(text, 1 + item_id % 7, 1 + item_id % 45)").alias("part"))
    docs = spread(t.documents.select("doc_id", "text"))
    return E.containment_pairs(docs, "doc_id", "text", items, "item_id", "part")


@query("er_gold_evaluation", "L35,C5,C9", _SIMS + """
SELECT (SELECT count(*) FROM gold) AS n_true_dups,
       (SELECT floor(avg(COALESCE(s.sim, 0)) * 1000000 + 0.5) / 1000000 FROM gold g
          LEFT JOIN sims s ON g.doc_id = s.doc_id AND g.item_id = s.item_id) AS avg_sim_dups,
       (SELECT floor(avg(s.sim) * 1000000 + 0.5) / 1000000 FROM sims s
          WHERE NOT EXISTS (SELECT 1 FROM gold g WHERE g.doc_id = s.doc_id AND g.item_id = s.item_id)) AS avg_sim_non_dups,
       (SELECT floor(sum(sim) / (SELECT count(*) FROM documents) / (SELECT count(*) FROM benchmark) * 1e9 + 0.5) / 1e9
          FROM sims) AS avg_sim_all_pairs
""")
def _(spark, sf):
    t, g = Tables(spark, sf), written(gold(spark, sf), "gold-pairs")
    sims = written(similarities(spark, sf), "similarities")
    ev = E.gold_evaluation(sims, g, sims.join(g, ["doc_id", "item_id"], "left_semi"))
    n = t.documents.agg(F.count(F.lit(1)).alias("n_a")).crossJoin(t.benchmark.agg(F.count(F.lit(1)).alias("n_b")))
    total = sims.agg(F.coalesce(F.sum("sim"), F.lit(0.0)).alias("total_sim")).crossJoin(F.broadcast(n))
    return ev.crossJoin(F.broadcast(total)).select(
        "n_true_dups", fixed("avg_sim_dups", 6).alias("avg_sim_dups"), fixed("avg_sim_non_dups", 6).alias("avg_sim_non_dups"),
        fixed(F.col("total_sim") / F.col("n_a") / F.col("n_b"), 9).alias("avg_sim_all_pairs"))


@query("er_threshold_sweep", "L36,D40,E1", _SIMS + """,
gs AS (SELECT least(floor(COALESCE(s.sim, 0) * 100), 100) AS bin FROM gold g
       LEFT JOIN sims s ON g.doc_id = s.doc_id AND g.item_id = s.item_id),
fs AS (SELECT least(floor(sim * 100), 100) AS bin FROM sims s
       WHERE NOT EXISTS (SELECT 1 FROM gold g WHERE g.doc_id = s.doc_id AND g.item_id = s.item_id)),
t AS (SELECT i / 100 AS threshold, i,
             (SELECT count(*) FROM fs WHERE bin >= i) AS false_pos,
             (SELECT count(*) FROM gs WHERE bin < i) AS false_neg,
             (SELECT count(*) FROM gs) - (SELECT count(*) FROM gs WHERE bin < i) AS true_pos
      FROM range(0, 100) r(i))
SELECT threshold, false_pos, false_neg, true_pos,
       floor(true_pos / NULLIF(true_pos + false_pos, 0) * 1e9 + 0.5) / 1e9 AS precision,
       floor(true_pos / NULLIF(true_pos + false_neg, 0) * 1e9 + 0.5) / 1e9 AS recall,
       floor((2 * (true_pos / NULLIF(true_pos + false_neg, 0)) * (true_pos / NULLIF(true_pos + false_pos, 0)))
             / NULLIF(true_pos / NULLIF(true_pos + false_neg, 0) + true_pos / NULLIF(true_pos + false_pos, 0), 0)
             * 1e9 + 0.5) / 1e9 AS fmeasure
FROM t
""")
def _(spark, sf):
    s = E.threshold_sweep(similarities(spark, sf), written(gold(spark, sf), "gold-pairs"))
    return s.select("threshold", "false_pos", "false_neg", "true_pos",
                    fixed("precision", 9).alias("precision"), fixed("recall", 9).alias("recall"),
                    fixed("fmeasure", 9).alias("fmeasure"))
