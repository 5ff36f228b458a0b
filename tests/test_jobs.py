"""Composed jobs on small inputs: results checked against brute force."""

import itertools
import math

from pyspark.sql import functions as F

from kestrel.jobs import entity as E
from kestrel.jobs import weblogs as L
from kestrel.jobs import markets as M


def test_log_parse_line(spark):
    line = '127.0.0.1 - - [01/Aug/1995:00:00:01 -0400] "GET /images/launch-logo.gif HTTP/1.0" 200 1839'
    bad = 'garbage line'
    df = spark.createDataFrame([(line,), (bad,), ('h - - [01/Aug/1995:00:00:09 -0400] "GET /x HTTP/1.0 " 404 -',)],
                               "value string")
    p = L.parse_logs(df).orderBy("value").collect()
    ok = [r for r in p if r.ok]
    assert len(ok) == 2
    r = [x for x in ok if x.host == "127.0.0.1"][0]
    assert (r.method, r.endpoint, r.protocol, r.response_code, r.content_size) == (
        "GET", "/images/launch-logo.gif", "HTTP/1.0", 200, 1839)
    assert [x for x in ok if x.host == "h"][0].content_size == 0
    strict = L.parse_logs(df, pattern=L.CLF_STRICT).where("ok").count()
    assert strict == 1


def test_cosine_pairs_equal_brute_force(spark):
    a = [(1, "red apple pie"), (2, "green apple"), (3, "blue sky")]
    b = [(10, "apple pie recipe"), (11, "sky blue ocean")]
    da = spark.createDataFrame(a, "id long, text string")
    db = spark.createDataFrame(b, "id long, text string")
    ra = E.record_tokens(da, "id", "text", stop_words=[], source="a")
    rb = E.record_tokens(db, "id", "text", stop_words=[], source="b")
    rec = ra.unionByName(rb)
    keys = ("source", "id")
    w = E.tfidf(E.term_frequency(rec, keys), E.inverse_document_frequency(rec, keys))
    wa, wb = w.where("source='a'").drop("source"), w.where("source='b'").drop("source")
    got = {(r.a_id, r.b_id): r.sim for r in E.cosine_pairs(wa, wb, salt_buckets=3).collect()}
    # brute force
    docs = {("a", i): t.split() for i, t in a}
    docs.update({("b", i): t.split() for i, t in b})
    n = len(docs)
    df_t = {}
    for toks in docs.values():
        for t in set(toks):
            df_t[t] = df_t.get(t, 0) + 1
    vec = {k: {t: toks.count(t) / len(toks) * n / df_t[t] for t in set(toks)} for k, toks in docs.items()}
    exp = {}
    for (i, _), (j, _) in itertools.product(a, b):
        va, vb = vec[("a", i)], vec[("b", j)]
        dot = sum(va[t] * vb.get(t, 0) for t in va)
        if dot > 0:
            exp[(i, j)] = dot / (math.sqrt(sum(x * x for x in va.values())) * math.sqrt(sum(x * x for x in vb.values())))
    assert set(got) == set(exp)
    assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_containment_pairs_exact(spark):
    docs = spark.createDataFrame([(1, "intro words. the quick brown fox jumps over it. end"), (2, "nothing here"),
                                  (3, "short one")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "the quick brown fox jumps over it."), (8, "short one")],
                                  "item_id long, text string")
    got = sorted(tuple(r) for r in E.containment_pairs(docs, "doc_id", "text", items, "item_id", "text").collect())
    assert got == [(1, 7), (3, 8)]


def test_threshold_sweep_counts(spark):
    sims = spark.createDataFrame([(1, 1, 0.95), (2, 1, 0.5), (3, 1, 0.05)], "doc_id long, item_id long, sim double")
    gold = spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, item_id long")
    s = {round(r.threshold, 2): r for r in E.threshold_sweep(sims, gold).collect()}
    assert s[0.0].false_pos == 2 and s[0.0].true_pos == 2 and s[0.0].false_neg == 0
    assert s[0.5].false_pos == 1 and s[0.5].true_pos == 1 and s[0.5].false_neg == 1
    assert s[0.96].false_pos == 0 and s[0.96].true_pos == 0


def test_put_call_ratio_matches_pivot_join(spark):
    rows = [("d1", "S", "E", "OPTSTK", "PE", 6.0), ("d1", "S", "E", "OPTSTK", "CE", 3.0),
            ("d1", "S", "E", "FUTSTK", "XX", 5.0), ("d1", "T", "E", "FUTSTK", "XX", 1.0),
            ("d2", "S", "E", "OPTSTK", "PE", 2.0), ("d2", "S", "E", "OPTSTK", "CE", 0.0)]
    g = spark.createDataFrame(rows, "rts string, SYMBOL string, EXPIRY_DT string, INSTRUMENT string, "
                                    "OPTION_TYP string, CONTRACTS double")
    w = M.add_put_call_ratio(g, ["rts", "SYMBOL", "EXPIRY_DT"])
    p = M.pcr_pivot(g, ["rts", "SYMBOL", "EXPIRY_DT"]).select("rts", "SYMBOL", "EXPIRY_DT", "PCR")
    j = g.join(p, ["rts", "SYMBOL", "EXPIRY_DT"])
    key = lambda r: (r.rts, r.SYMBOL, r.INSTRUMENT, r.OPTION_TYP)
    assert sorted((key(r), r.PCR) for r in w.collect()) == sorted((key(r), r.PCR) for r in j.collect())
    assert {r.PCR for r in w.where("rts='d1'").collect()} == {2.0}
    assert {r.PCR for r in w.where("rts='d2'").collect()} == {None}


def test_versioned_table(spark, tmp_path):
    from kestrel.sources.versioned import VersionedTable
    t = VersionedTable(spark, str(tmp_path / "vt"))
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "k int, s string, x double")
    t.create(base)
    t.update(F.col("x") > 1.5, {"s": F.lit("B")})
    t.delete(F.col("x") < 0)               # x NULL → predicate NULL → row kept
    t.merge(spark.createDataFrame([(2, "z", 9.0), (4, "d", 4.0)], "k int, s string, x double"), ["k"])
    cur = sorted(tuple(r) for r in t.read().collect())
    assert cur == [(1, "a", 1.0), (2, "B", 2.0), (3, "c", None), (4, "d", 4.0)]
    assert sorted(tuple(r) for r in t.read(version=0).collect()) == sorted(tuple(r) for r in base.collect())
    assert [r.operation for r in t.history().orderBy("version").collect()] == ["CREATE", "UPDATE", "DELETE", "MERGE"]
    assert t.vacuum(retain_versions=2) == [0, 1]
