"""Daily loads with a ledger, the recommender's steps, side effects and plans."""

import contextlib
import io
import random
import re

from pyspark.sql import functions as F

from kestrel.jobs import weblogs as L
from kestrel.ml import recommender as REC
from kestrel.operators import relational as R
from kestrel.sources import daily as D


def test_backfill_goes_on_after_a_failed_day_and_reloads(spark, tmp_path):
    tree, table, ledger = (str(tmp_path / x) for x in ("tree", "table", "ledger"))
    rows = [(2024, m, d, f"{m}-{d}", float(d)) for m in (2, 11) for d in (1, 9, 10)]
    df = spark.createDataFrame(rows, "year int, month int, day int, k string, v double")
    df.write.partitionBy("year", "month", "day").option("header", "true").csv(tree)
    days = D.days_in_tree(spark, tree)
    assert days == [(2024, 2, 1), (2024, 2, 9), (2024, 2, 10), (2024, 11, 1), (2024, 11, 9), (2024, 11, 10)]
    broken = {(2024, 2, 10)}

    def loader(day):
        if day in broken:
            raise RuntimeError("unreadable")
        return D.load_day(spark, tree, table, day, "csv", {"header": "true"}, "k string, v double",
                          lambda x: x.withColumn("v", F.col("v") * 2))

    first = {(r.year, r.month, r.day): (r.attempt, r.status, r.rows) for r in D.backfill(spark, days, loader, ledger).collect()}
    assert first[2024, 2, 10] == (1, "failed", 0) and first[2024, 11, 10] == (1, "ok", 1) and len(first) == 6
    assert D.open_days(spark, ledger) == [(2024, 2, 10)]
    broken.clear()
    D.backfill(spark, [*D.open_days(spark, ledger), (2024, 11, 10)], loader, ledger)
    assert D.open_days(spark, ledger) == []
    assert D.read_ledger(spark, ledger).count() == 8
    got = sorted((r.month, r.day, r.k, r.v) for r in spark.read.parquet(table).collect())
    assert got == sorted((m, d, k, 2 * v) for _, m, d, k, v in rows)


def test_names_and_aliases(spark):
    lines = spark.createDataFrame([("1\tOne",), ("2\t  ",), ("x\tBad",), ("3",), ("4\tFour\tmore",), ("",), (None,)], "value string")
    assert sorted(map(tuple, REC.clean_names(lines).collect())) == [(1, "One"), (4, "Four\tmore")]
    lines = spark.createDataFrame([("1\t2",), ("1\t5",), ("\t7",), ("3\t3",), ("8\tx",), ("9\t1",)], "value string")
    assert sorted(map(tuple, REC.clean_aliases(lines).collect())) == [(1, 2), (9, 1)]


def test_aliases_follow_chains_and_circles(spark):
    chain = [(i, i + 1) for i in range(100, 137)]
    circle = [(1, 2), (2, 3), (3, 1)]
    tail = [(50, 51), (51, 2)]
    df = spark.createDataFrame(chain + circle + tail + [(200, 137)], "id long, target long")
    got = {r.id: r.target for r in REC.resolve_aliases(df).collect()}
    assert got == {**{i: 137 for i in range(100, 137)}, 200: 137, 2: 1, 3: 1, 50: 1, 51: 1}
    assert REC.resolve_aliases(df.limit(0)).count() == 0
    plays = spark.createDataFrame([(7, 100), (7, 3), (7, 999), (7, None)], "user int, item int")
    canon = REC.with_canonical(plays, "item", REC.resolve_aliases(df))
    assert [r.item for r in canon.orderBy("item").collect()] == [None, 1, 137, 999] and canon.dtypes == plays.dtypes


def test_negative_draws(spark):
    rand = random.Random(2)
    pos = {(u, rand.randrange(40)) for u in range(1, 6) for _ in range(5 * u)} | {(9, i) for i in range(40)}
    df = spark.createDataFrame(sorted(pos), "user int, item int").repartition(3)
    rows = REC.negative_draws(df, spark.range(40).withColumnRenamed("id", "item"), "user", "item").collect()
    got = [(r.user, r.item) for r in rows]
    assert not set(got) & pos and {u for u, _ in got} == {1, 2, 3, 4, 5}
    for u in range(1, 6):
        assert sum(x == u for x, _ in got) == sum(x == u for x, _ in pos)
    assert len({i for _, i in got}) > 15


def test_auc_by_group_and_sweep(spark):
    rows = [(1, 0.9, True), (1, 0.5, True), (1, 0.5, False), (1, 0.1, False), (2, 0.2, True), (3, 0.4, False), (1, None, True)]
    df = spark.createDataFrame(rows, "user int, score double, pos boolean")
    assert [tuple(r) for r in REC.auc_by_group(df, ["user"], "score", "pos").collect()] == [(1, 3, 2, 2, 0.75)]
    plays = [(u, i, 5) for u in range(12) for i in range(12) if (u + i) % 2 == 0]
    train = spark.createDataFrame([p for p in plays if (p[0] * 7 + p[1]) % 5], "user int, item int, plays int")
    test = spark.createDataFrame([p for p in plays if not (p[0] * 7 + p[1]) % 5], "user int, item int, plays int")
    neg = spark.createDataFrame([(u, i) for u in range(12) for i in range(12) if (u + i) % 2], "user int, item int")
    grid = [{"rank": 2, "reg": 0.01, "alpha": 10.0}, {"rank": 3, "reg": 0.1, "alpha": 1.0}]
    out = REC.auc_sweep(train, test, neg, "user", "item", "plays", grid, max_iter=8).collect()
    assert {(r["rank"], r.reg, r.alpha) for r in out} == {(2, 0.01, 10.0), (3, 0.1, 1.0)}
    assert all(0.8 < r.mean_auc <= 1 and r.users == 12 for r in out)


def test_auc_sweep_reads_the_held_out_rows_once(spark, tmp_path):
    from kestrel.ml.jobs import als_implicit
    rand = random.Random(8)
    plays = [(u, i, rand.randrange(1, 9)) for u in range(15) for i in range(20) if rand.random() < 0.5]
    train = spark.createDataFrame([p for p in plays if p[1] != 19 and p[0] != 14], "user int, item int, plays int").coalesce(1)
    test = spark.createDataFrame(plays[::3], "user int, item int, plays int")          # with a user and an item unknown in training
    neg = spark.createDataFrame([(u, i) for u in range(15) for i in range(20) if (u + i) % 3 == 0] * 2, "user int, item int")
    neg.write.parquet(str(tmp_path / "neg"))
    neg = spark.read.parquet(str(tmp_path / "neg"))
    grid = [{"rank": 2, "reg": 0.01, "alpha": 1.0}, {"rank": 3, "reg": 0.1, "alpha": 40.0}, {"rank": 2, "reg": 1.0, "alpha": 40.0}]
    out = REC.auc_sweep(train, test, neg, "user", "item", "plays", grid)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain("formatted")
    assert len(re.findall(r"^\(\d+\) Scan parquet", text.getvalue(), re.M)) == 1
    got = {(r["rank"], r.reg, r.alpha): (r.mean_auc, r.users) for r in out.collect()}
    for p in grid:
        model = als_implicit(train, "user", "item", "plays", rank=p["rank"], reg=p["reg"], alpha=p["alpha"], max_iter=5)
        rows = test.select("user", "item", F.lit(True).alias("pos")).unionByName(neg.withColumn("pos", F.lit(False)))
        auc = REC.auc_by_group(model.transform(rows), ["user"], "prediction", "pos").agg(F.avg("auc"), F.count("auc")).first()
        mean, users = got[p["rank"], p["reg"], p["alpha"]]
        assert abs(mean - auc[0]) < 0.01 and users == auc[1]


def test_als_blocks_grow_with_the_ratings(spark, monkeypatch):
    from kestrel.ml import jobs as ML
    rand = random.Random(4)
    plays = [(u, i, rand.randrange(1, 9)) for u in range(60) for i in range(40) if (u + i) % 2 == 0]
    train = spark.createDataFrame(plays, "user int, item int, plays int")
    neg = spark.createDataFrame([(u, i) for u in range(60) for i in range(40) if (u + i) % 2], "user int, item int")
    fit = lambda: ML.als_implicit(train, "user", "item", "plays", rank=3, max_iter=4)          # noqa: E731
    assert fit().userFactors.rdd.getNumPartitions() == 10
    monkeypatch.setattr(ML, "BLOCK_RATINGS", 50, raising=False)                                # 1,200 ratings
    model = fit()
    assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == 24
    assert (model.userFactors.count(), model.itemFactors.count()) == (60, 40)
    sweep = REC.auc_sweep(train, train, neg, "user", "item", "plays", [{"rank": 3, "reg": 0.01, "alpha": 10.0}]).first()
    assert 0.9 < sweep.mean_auc <= 1 and sweep.users == 60


def test_top_items_and_users_of_a_subset(spark):
    from kestrel.ml.jobs import als_implicit
    plays = spark.createDataFrame([(u, i, 5) for u in range(10) for i in range(10) if (u + i) % 2 == 0], "user int, item int, plays int")
    model = als_implicit(plays, "user", "item", "plays", rank=2, max_iter=5)
    names = spark.createDataFrame([(i, f"item {i}") for i in range(9)], "id long, name string")
    rows = REC.top_items(model, spark.createDataFrame([(0,), (3,)], "user int"), 3, names).collect()
    assert {r.user for r in rows} == {0, 3} and sorted(r["rank"] for r in rows) == [1, 1, 2, 2, 3, 3]
    assert all((r.user + r.item) % 2 == 0 and r.name == (f"item {r.item}" if r.item < 9 else None) for r in rows)
    rows = REC.top_users(model, spark.createDataFrame([(4,)], "item int"), 2).collect()
    assert len(rows) == 2 and all(r.user % 2 == 0 for r in rows)


def test_top_products_go_by_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(REC, "ASKED_BLOCK", 4)
    monkeypatch.setattr(REC, "OFFERED_BLOCK", 50)
    rand = random.Random(6)
    vectors = {i: [float(rand.randrange(-9, 10)) for _ in range(3)] for i in range(400)}
    vectors[399] = vectors[7]                                # equal vectors: the larger id first
    df = spark.createDataFrame([(i, v) for i, v in vectors.items()], "id int, features array<float>")
    got = REC.best_products(df.where("id % 20 = 0"), df, 5)
    pairs = REC._in_blocks(df.where("id % 20 = 0"), 4, "a").hint("shuffle_replicate_nl").crossJoin(REC._in_blocks(df, 50, "o"))
    assert pairs.rdd.getNumPartitions() == 5 * 8             # a task per pair of blocks, however many there are
    by: dict = {}
    for r in got.collect():
        by.setdefault(r.id, []).append((r["rank"], r.score, r.other))
    assert set(by) == set(range(0, 400, 20))
    for u, rows in by.items():
        dot = {i: sum(a * b for a, b in zip(vectors[u], v)) for i, v in vectors.items()}
        assert [s for _, s, _ in sorted(rows)] == sorted(dot.values(), reverse=True)[:5] and sorted(r for r, _, _ in rows) == [1, 2, 3, 4, 5]
        found = [o for _, _, o in rows]
        assert all(dot[o] == s for _, s, o in rows) and (7 not in found or 399 in found)
    assert REC.best_products(df.where("id < 0"), df, 5).count() == REC.best_products(df, df.where("id < 0"), 5).count() == 0


def test_foreach_counters_and_width(spark):
    df = spark.range(1000).repartition(6)
    assert R.foreach_counted(df, lambda r: r.id % 10 == 0) == (1000, 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    narrow = R.session_with_width(spark, 3)
    keys = narrow.range(100).select((F.col("id") % 10).alias("k"))
    assert keys.groupBy("k").count().rdd.getNumPartitions() == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_filters_and_columns_reach_the_scan(spark):
    q = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where(F.col("l_quantity") > 49).select("l_orderkey", "l_quantity")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        q.explain("formatted")
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,49" in out.getvalue()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in out.getvalue()


def test_log_lines_with_the_separator_and_tails(spark):
    line = 'h - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 5'
    odd = ['h\x01 - - [01/Aug/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 5', line + " more text\nand lines", "a\x01b", "", None]
    rows = L.parse_logs(spark.createDataFrame([(line,), *[(x,) for x in odd]], "value string")).collect()
    by = {r.value: r for r in rows}
    assert [by[x].ok for x in (line, *odd)] == [True, True, True, False, False, False]
    assert by[odd[0]].host == "h\x01" and by[odd[1]].content_size == 5 and by["a\x01b"].host == "" and by[line].endpoint == "/x"


def test_models_keep_rows_with_null_features(spark):
    from kestrel.ml import jobs as ML
    rand = random.Random(4)
    rows = [(i, None if i % 7 == 0 else float(rand.randrange(100)), None, rand.random()) for i in range(600)]
    df = spark.createDataFrame([(*r, "hi" if (r[1] or 50) > 50 else "lo", 2.0 * (r[1] or 50) + 1) for r in rows],
                               "id long, a double, b double, c double, label string, y double")
    out = ML.forest_report(df, ["a", "b", "c"], "label", ["id"]).collect()
    cells = sum(r.value for r in out if r.part == "confusion")
    assert cells == ML.hashed_split(df, ["id"])[1].count()
    accuracy = {r.name: r.value for r in out if r.part == "accuracy"}
    assert all(0.8 < v <= 1 for v in accuracy.values())
    weights = [sum(r.value for r in out if r.part == "importance" and r.name.startswith(m)) for m in ("forest", "tree")]
    assert all(abs(w - 1) < 1e-6 for w in weights)
    line = {(r.part, r.name): r.value for r in ML.cross_validated_regression(df, ["a", "c"], "y", ["id"]).collect()}
    assert line["held out", "r2"] > 0.9 and abs(line["coefficient", "a"] - 2) < 0.3


def test_anomalies_are_the_farthest_rows(spark):
    from kestrel.ml import jobs as ML
    from pyspark.ml.linalg import Vectors
    rand = random.Random(1)
    rows = [(i, Vectors.dense([c + rand.gauss(0, 0.1), c + rand.gauss(0, 0.1)])) for i, c in enumerate([0, 10] * 100)]
    rows += [(900 + i, Vectors.dense([5.0, 5.0])) for i in range(6)]                  # ties beyond the threshold
    df = spark.createDataFrame(rows, ["id", "f"])
    out = ML.anomalies(df, "f", k=2, top=4).collect()
    assert {r.id for r in out} >= {900 + i for i in range(6)} and sorted(r["rank"] for r in out) == list(range(1, len(out) + 1))
    far = [r.distance for r in sorted(out, key=lambda r: r["rank"])]
    assert far == sorted(far, reverse=True)
    sweep = {r.k: r for r in ML.entropy_sweep(df.withColumn("label", (F.col("id") % 2).cast("string")), "f", "label", [2, 4]).collect()}
    assert sweep[2].silhouette > 0.8 and sweep[2].weighted_entropy < 0.2


def test_samples_and_random_numbers_keep_their_promises(spark):
    from kestrel.plans.registry import load_all
    reg, sf = load_all(), "/root/testdata/sf0.01"
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    n = orders.count()
    some = reg["sample_bernoulli_seeded"].fn(spark, sf)
    keys = [r[0] for r in some.collect()]
    assert 0.08 * n < len(keys) < 0.12 * n and len(set(keys)) == len(keys)
    assert some.join(orders, "o_orderkey", "left_anti").count() == 0
    assert sorted(keys) == sorted(r[0] for r in reg["sample_bernoulli_seeded"].fn(spark, sf).collect())
    parts = {r.split: r.n for r in reg["random_split_by_hash"].fn(spark, sf).collect()}
    assert sum(parts.values()) == n and 0.17 * n < min(parts.values()) < 0.23 * n
    u = reg["random_numbers_seeded"].fn(spark, sf).agg(F.min("u"), F.max("u"), F.avg("u"), F.min("die"), F.max("die"), F.count_distinct("die")).first()
    assert 0 <= u[0] and u[1] < 1 and 0.45 < u[2] < 0.55 and (u[3], u[4], u[5]) == (0, 5, 6)
    near = {r.o_orderstatus: r for r in reg["percentile_approx_sketch"].fn(spark, sf).collect()}
    exact = spark.read.parquet(f"{sf}/orders.parquet").groupBy("o_orderstatus").agg(
        F.percentile("o_totalprice", 0.5).alias("m"), F.count_distinct("o_custkey").alias("c")).collect()
    for r in exact:
        assert abs(near[r.o_orderstatus].median_approx - r.m) < 0.02 * r.m
        assert abs(near[r.o_orderstatus].customers_approx - r.c) < 0.2 * r.c


def test_cost_sweep_variants(spark):
    from kestrel.ml import jobs as ML
    from pyspark.ml.linalg import Vectors
    rand = random.Random(5)
    rows = [(Vectors.dense([rand.gauss(c * 5, 1), rand.gauss(c, 1), 100 * rand.random()]), f"s{c}") for c in range(3) for _ in range(60)]
    got = {(r.variant, r.k): r.cost for r in ML.cost_sweep(spark.createDataFrame(rows, ["f", "s"]), "f", "s", [2, 3, 6]).collect()}
    assert len(got) == 12
    for v in ("raw", "iterated", "scaled", "encoded"):
        assert got[v, 2] > got[v, 3] > got[v, 6] > 0
    assert got["iterated", 6] <= got["raw", 6] * 1.2
