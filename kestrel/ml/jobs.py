"""Machine-learning jobs on DataFrames using Spark
MLlib estimators; post-processing (distances, thresholds, AUC, entropy)
is native DataFrame code — no driver-side loops over rows."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (ClusteringEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import squared_distance
from ..operators.aggregate import weighted_entropy
from ..operators.joins import zip_with_index
from ..session import written


def kmeans_pipeline(features: str, k: int, seed: int = 1, max_iter: int = 20, scale: bool = True):
    """M5-M7: (optional std scaling, no centring) → k-means."""
    stages = []
    col = features
    if scale:
        stages.append(StandardScaler(inputCol=features, outputCol="scaled", withMean=False, withStd=True))
        col = "scaled"
    stages.append(KMeans(featuresCol=col, predictionCol="cluster", k=k, seed=seed, maxIter=max_iter))
    return Pipeline(stages=stages), col


def distance_to_centre(model_df: DataFrame, centres: list, feature_col: str) -> DataFrame:
    """Squared distance of each row to its cluster centre.  The k
    centres are a k-row table joined by cluster id (k is a parameter)."""
    spark = model_df.sparkSession
    c = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(centres)],
                              "cluster int, centre array<double>")
    x = model_df.withColumn("__f", vector_to_array(feature_col))
    return (x.join(F.broadcast(c), "cluster")
             .withColumn("distance", F.sqrt(squared_distance("__f", "centre"))).drop("__f", "centre"))


def anomalies(df: DataFrame, features: str, k: int = 8, top: int = 20, seed: int = 1, max_iter: int = 20):
    """Fit, distance to own centre, threshold = ``top``-th largest
    distance (F8), rows at or above it ranked by distance."""
    pipe, col = kmeans_pipeline(features, k, seed, max_iter)
    model = pipe.fit(df)
    scored = model.transform(df)
    centres = model.stages[-1].clusterCenters()
    d = written(distance_to_centre(scored, centres, col), "distances")
    thr = d.select("distance").orderBy(F.desc("distance")).limit(top).agg(F.min("distance").alias("__t"))
    flagged = d.crossJoin(F.broadcast(thr)).where(F.col("distance") >= F.col("__t")).drop("__t")
    names = [c for c in df.columns if c != features]
    # the rank in one total order by ranges: ties at the threshold may be many
    return zip_with_index(flagged.withColumn("__far", -F.col("distance")), ["__far", *names], "rank").withColumn(
        "rank", (F.col("rank") + 1).cast("int")).drop("__far")


def entropy_sweep(df: DataFrame, features: str, label: str, ks: list[int], seed: int = 1, max_iter: int = 10):
    """Weighted label entropy and silhouette per k — each
    score from the model fitted for that k."""
    spark = df.sparkSession
    rows = []
    for k in ks:
        pipe, col = kmeans_pipeline(features, k, seed, max_iter)
        pred = pipe.fit(df).transform(df)
        h = weighted_entropy(pred, "cluster", label).first()[0]
        sil = ClusteringEvaluator(featuresCol=col, predictionCol="cluster").evaluate(pred)
        rows.append((k, float(h), float(sil)))
    return spark.createDataFrame(rows, "k int, weighted_entropy double, silhouette double")


def cost_sweep(df: DataFrame, features: str, text_col: str, ks: list[int], seed: int = 1) -> DataFrame:
    """M3/M9: (variant, k, cost): the mean squared distance to the nearest centre
    for growing k, in four variants: ``raw`` features with few iterations,
    ``iterated`` (more of them, to a smaller tolerance), ``scaled`` to unit
    deviation, and ``encoded``, scaled with the string column as one-hot slots
    beside them.  Costs are comparable within a variant."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    index = StringIndexer(inputCol=text_col, outputCol="__index", handleInvalid="keep")
    hot = OneHotEncoder(inputCol="__index", outputCol="__hot")
    both = VectorAssembler(inputCols=[features, "__hot"], outputCol="__both")
    data = written(Pipeline(stages=[index, hot, both]).fit(df).transform(df).select(features, "__both"), "sweep")
    n = data.count()
    rows = []
    for variant, col, scale, rounds, tol in (("raw", features, False, 5, 1e-4), ("iterated", features, False, 40, 1e-5),
                                             ("scaled", features, True, 40, 1e-5), ("encoded", "__both", True, 40, 1e-5)):
        for k in ks:
            pipe, _ = kmeans_pipeline(col, k, seed, rounds, scale)
            pipe.getStages()[-1].setTol(tol)
            rows.append((variant, k, float(pipe.fit(data).stages[-1].summary.trainingCost) / max(n, 1)))
    return df.sparkSession.createDataFrame(rows, "variant string, k int, cost double")


def unit_deviation(df: DataFrame, features: str, out: str) -> DataFrame:
    """M5: every slot of a vector divided by its standard deviation, not centred,
    as an array."""
    model = StandardScaler(inputCol=features, outputCol="__scaled", withMean=False, withStd=True).fit(df)
    return model.transform(df).withColumn(out, vector_to_array("__scaled")).drop("__scaled")


def encoded_strings(df: DataFrame, cols: list[str]) -> DataFrame:
    """M2/M3: per string column its index (by frequency, then by name) and its
    one-hot slots (without one for the last index), as ``<col>_index``, ``<col>_slots``."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    index = StringIndexer(inputCols=cols, outputCols=[f"{c}_index" for c in cols])
    hot = OneHotEncoder(inputCols=[f"{c}_index" for c in cols], outputCols=[f"__hot_{c}" for c in cols])
    out = Pipeline(stages=[index, hot]).fit(df).transform(df)
    return out.withColumns({f"{c}_slots": vector_to_array(f"__hot_{c}") for c in cols}).drop(*[f"__hot_{c}" for c in cols])


def category_slots(df: DataFrame, numeric: list[str], max_categories: int) -> DataFrame:
    """M1/M4: the columns as a vector whose slots with few values hold the number of
    the value instead; as an array ``slots``."""
    from pyspark.ml.feature import VectorIndexer
    pipe = Pipeline(stages=[VectorAssembler(inputCols=numeric, outputCol="__raw"),
                            VectorIndexer(inputCol="__raw", outputCol="__slots", maxCategories=max_categories)])
    return pipe.fit(df).transform(df).withColumn("slots", vector_to_array("__slots")).drop("__raw", "__slots")


def least_squares(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Coefficients of the plain linear regression, solved exactly: (name, value)."""
    from pyspark.ml.regression import LinearRegression
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="__f"),
                            LinearRegression(featuresCol="__f", labelCol=label, solver="normal", regParam=0.0)])
    line = pipe.fit(df).stages[-1]
    rows = [(n, float(x)) for n, x in zip([*features, "intercept"], [*line.coefficients, line.intercept])]
    return df.sparkSession.createDataFrame(rows, "name string, value double")


def regression_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(metric, value) of given predictions."""
    ev = RegressionEvaluator(labelCol=label, predictionCol=prediction)
    rows = [(m, float(ev.setMetricName(m).evaluate(df))) for m in ("rmse", "mae", "r2")]
    return df.sparkSession.createDataFrame(rows, "metric string, value double")


def classification_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(metric, value) of given predictions: accuracy, F1, and the cells of
    the confusion matrix."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction)
    rows = [(m, float(ev.setMetricName(m).evaluate(df))) for m in ("accuracy", "f1")]
    cells = df.groupBy(label, prediction).count().select(
        F.concat(F.lit("cell "), F.col(label).cast("int"), F.lit(" as "), F.col(prediction).cast("int")).alias("metric"),
        F.col("count").cast("double").alias("value"))
    return df.sparkSession.createDataFrame(rows, "metric string, value double").unionByName(cells)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Class proportions divided by the computed total."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("__N"))
    return c.crossJoin(F.broadcast(total)).select(label, "n", (F.col("n") / F.col("__N")).alias("p"))


def random_guess_accuracy(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Σ_c p_train(c) · p_test(c)."""
    a = class_distribution(train, label).select(label, F.col("p").alias("pa"))
    b = class_distribution(test, label).select(label, F.col("p").alias("pb"))
    return a.join(b, label).agg(F.sum(F.col("pa") * F.col("pb")).alias("accuracy"))


def linear_regression(df: DataFrame, features: list[str], label: str, reg: float = 0.1, enet: float = 0.5,
                      seed: int = 42, categorical: list[str] | None = None):
    """Index + one-hot encode categorical columns, assemble →
    linear regression (elastic net); RMSE and R² on a seeded hold-out."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    from pyspark.ml.regression import LinearRegression
    train, test = df.randomSplit([0.8, 0.2], seed)
    cats = categorical or []
    pre = []
    if cats:
        pre = [StringIndexer(inputCols=cats, outputCols=[f"{c}_idx" for c in cats], handleInvalid="keep"),
               OneHotEncoder(inputCols=[f"{c}_idx" for c in cats], outputCols=[f"{c}_vec" for c in cats])]
    inputs = features + [f"{c}_vec" for c in cats]
    pipe = Pipeline(stages=pre + [VectorAssembler(inputCols=inputs, outputCol="features"),
                            LinearRegression(featuresCol="features", labelCol=label, regParam=reg,
                                             elasticNetParam=enet, maxIter=20)])
    model = pipe.fit(train)
    pred = model.transform(test)
    rmse = RegressionEvaluator(labelCol=label, metricName="rmse").evaluate(pred)
    r2 = RegressionEvaluator(labelCol=label, metricName="r2").evaluate(pred)
    return model, rmse, r2


def tuned_forest(df: DataFrame, features: str, label: str, seed: int = 7):
    """Decision tree and random forest with a small grid and a
    train/validation split; accuracy, F1 and confusion matrix (M18 as
    groupBy(label).pivot(prediction).count())."""
    from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed)
    grid = ParamGridBuilder().addGrid(rf.numTrees, [5, 10]).addGrid(rf.maxDepth, [3, 5]).build()
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    tvs = TrainValidationSplit(estimator=rf, estimatorParamMaps=grid, evaluator=ev, trainRatio=0.8, seed=seed)
    model = tvs.fit(df)
    pred = model.transform(df)
    tree = DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=5, seed=seed).fit(df)
    confusion = pred.groupBy(label).pivot("prediction").count()
    f1 = MulticlassClassificationEvaluator(labelCol=label, metricName="f1").evaluate(pred)
    return model, tree, ev.evaluate(pred), f1, confusion


BLOCK_RATINGS = 1 << 22  # ratings of a block: a task builds and holds a whole block in memory
LEAST_BLOCKS = 10        # MLlib's own number


def als_blocks(ratings: DataFrame) -> int:
    """Blocks of users, and of items, that keep a block at about ``BLOCK_RATINGS`` at most."""
    return max(LEAST_BLOCKS, -(-ratings.count() // BLOCK_RATINGS))


def als_implicit(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 10, reg: float = 0.1,
                 alpha: float = 1.0, max_iter: int = 10, seed: int = 3, blocks: int | None = None):
    """Implicit-feedback ALS.

    A fixed number of blocks would let the memory of a task grow with the ratings, so
    their number grows (``blocks``, or counted here); then blocks and factors stay on
    disk between steps, beside which a task has the memory to itself."""
    from pyspark.ml.recommendation import ALS
    blocks = blocks or als_blocks(ratings)
    level = "MEMORY_AND_DISK" if blocks <= LEAST_BLOCKS else "DISK_ONLY"
    als = ALS(userCol=user, itemCol=item, ratingCol=rating, implicitPrefs=True, rank=rank, regParam=reg,
              alpha=alpha, maxIter=max_iter, seed=seed, coldStartStrategy="drop", numUserBlocks=blocks,
              numItemBlocks=blocks, intermediateStorageLevel=level, finalStorageLevel=level)
    return als.fit(ratings)


def negative_samples(positives: DataFrame, items: DataFrame, user: str, item: str, per_user: int,
                     seed: int = 5) -> DataFrame:
    """per user, ``per_user`` seeded random item draws from the item
    table, minus items the user has seen — all distributed (the item table
    gets a dense index; draws are index lookups by equi-join)."""
    from ..operators.joins import zip_with_index
    idx = zip_with_index(items.select(item).distinct(), [item], "__i")
    n_items = idx.agg(F.count(F.lit(1)).alias("__n"))
    users = positives.select(user).distinct().crossJoin(F.broadcast(n_items))
    draws = users.select(user, F.explode(F.sequence(F.lit(1), F.lit(per_user))).alias("__d"), "__n")
    draws = draws.withColumn("__i", F.pmod(F.xxhash64(F.col(user), F.col("__d"), F.lit(seed)), F.col("__n")))
    cand = draws.join(idx, "__i").select(user, item).distinct()
    return cand.join(positives.select(user, item), [user, item], "left_anti")


def mean_auc(model, positives: DataFrame, negatives: DataFrame, user: str, item: str,
             keep_users_without_correct: bool = True) -> DataFrame:
    """Per user, the fraction of (positive, negative) pairs where
    the positive scores higher, averaged over users.  Computed by ranking —
    for each positive, the count of negatives scoring below it comes from a
    running count over the user's merged, score-ordered list — so no
    positive × negative pairs are formed.  Users without a pair are left out;
    users with pairs of which none is ranked right count as 0 (left join) unless ``keep_users_without_correct`` is
    False (the reference's inner-join form)."""
    p = model.transform(positives.select(user, item)).withColumn("__pos", F.lit(1))
    n = model.transform(negatives.select(user, item)).withColumn("__pos", F.lit(0))
    u = p.unionByName(n)
    w = Window.partitionBy(user).orderBy("prediction", F.desc("__pos")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = u.withColumn("__neg_below", F.coalesce(F.sum(1 - F.col("__pos")).over(w), F.lit(0)))
    per = ranked.groupBy(user).agg(
        F.sum(F.when(F.col("__pos") == 1, F.col("__neg_below")).otherwise(0)).alias("correct"),
        F.sum("__pos").alias("n_pos"), F.sum(1 - F.col("__pos")).alias("n_neg"))
    per = per.where("n_pos * n_neg > 0")          # no pair, nothing to rank
    per = per.withColumn("auc", F.try_divide(F.col("correct"), F.col("n_pos") * F.col("n_neg")))
    if not keep_users_without_correct:
        per = per.where("correct > 0")
    return per.agg(F.avg(F.coalesce("auc", F.lit(0.0))).alias("mean_auc"), F.count(F.lit(1)).alias("users"))


def embedding_features(df: DataFrame, array_col: str = "embedding", out: str = "features") -> DataFrame:
    """M1: array column → ML vector."""
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def hashed_split(df: DataFrame, keys: list[str], test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of ``keys``: the same split however often,
    and on whatever executor, the rows are read."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(100))
    return df.where(bucket >= test_percent), df.where(bucket < test_percent)


def filled(df: DataFrame, numeric: list[str]) -> tuple[DataFrame, list]:
    """``df`` with the numeric columns as doubles, and the stage that fills their
    nulls with the median of the rows it is fitted on, so no row is skipped.  A
    column of nulls only is 0."""
    from pyspark.ml.feature import Imputer
    empty = df.agg(*[F.count(c).alias(c) for c in numeric]).first()
    df = df.withColumns({c: (F.lit(0.0) if not empty[c] else F.col(c).cast("double")) for c in numeric})
    return df, [Imputer(inputCols=numeric, outputCols=[f"__full_{c}" for c in numeric], strategy="median")]


def forest_report(df: DataFrame, numeric: list[str], label: str, keys: list[str], max_categories: int = 8,
                  seed: int = 7) -> DataFrame:
    """A forest tuned by train/validation split and a single
    tree, both scored on held-out rows.  Rows (part, name, value): chosen
    parameters, importances, nodes of the tree, accuracy, F1, confusion cells.
    Nulls in numeric columns are filled by the training rows' median, a null label
    is a class of its own."""
    from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorIndexer
    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
    df, fill = filled(df, numeric)
    train, test = hashed_split(df, keys)
    prepare = Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="__label", handleInvalid="keep"), *fill,
        VectorAssembler(inputCols=[f"__full_{c}" for c in numeric], outputCol="__raw"),
        VectorIndexer(inputCol="__raw", outputCol="__features", maxCategories=max_categories,
                      handleInvalid="keep")]).fit(train)
    # the fits below read the rows again and again: prepared once
    train, test = (written(prepare.transform(x).select("__label", "__features"), f"forest-{n}")
                   for n, x in (("train", train), ("test", test)))
    forest = RandomForestClassifier(featuresCol="__features", labelCol="__label", seed=seed)
    grid = ParamGridBuilder().addGrid(forest.numTrees, [4, 8]).addGrid(forest.maxDepth, [3, 5]).build()
    accuracy = MulticlassClassificationEvaluator(labelCol="__label", metricName="accuracy")
    f1 = MulticlassClassificationEvaluator(labelCol="__label", metricName="f1")
    tuned = TrainValidationSplit(estimator=forest, estimatorParamMaps=grid, evaluator=accuracy, trainRatio=0.8,
                                 seed=seed).fit(train)
    best = tuned.bestModel
    tree = DecisionTreeClassifier(featuresCol="__features", labelCol="__label", maxDepth=4, seed=seed).fit(train)
    rows = [("parameter", "numTrees", float(best.getNumTrees)), ("parameter", "maxDepth", float(best.getMaxDepth())),
            ("tree", "nodes", float(tree.numNodes)), ("tree", "lines", float(len(tree.toDebugString.splitlines())))]
    rows += [("validation", ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda x: x[0].name)), float(m))
             for point, m in zip(grid, tuned.validationMetrics)]
    for name, model in (("forest", best), ("tree", tree)):
        scored = written(model.transform(test).select("__label", "prediction"), f"scored-{name}")
        if name == "forest":
            confusion = scored
        rows += [("accuracy", name, float(accuracy.evaluate(scored))), ("f1", name, float(f1.evaluate(scored)))]
        rows += [("importance", f"{name} {c}", float(x)) for c, x in zip(numeric, model.featureImportances.toArray())]
    cells = confusion.groupBy("__label", "prediction").count().select(
        F.lit("confusion").alias("part"), F.concat_ws(" as ", "__label", "prediction").alias("name"),
        F.col("count").cast("double").alias("value"))
    return df.sparkSession.createDataFrame(rows, "part string, name string, value double").unionByName(cells)


def cross_validated_regression(df: DataFrame, numeric: list[str], label: str, keys: list[str],
                               folds: int = 3) -> DataFrame:
    """Elastic-net regression chosen by cross-validation over
    hashed folds, then scored on held-out rows.  Rows (part, name, value).  Nulls in
    numeric columns are filled by the training rows' median; rows without a label
    cannot be scored and are left out."""
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    df, fill = filled(df.where(F.col(label).isNotNull()), numeric)
    train, test = hashed_split(df, keys)
    train = train.withColumn("__fold", F.pmod(F.xxhash64(*keys, F.lit("fold")), F.lit(folds)).cast("int"))
    line = LinearRegression(featuresCol="__features", labelCol=label, maxIter=20)
    grid = ParamGridBuilder().addGrid(line.regParam, [0.01, 1.0]).addGrid(line.elasticNetParam, [0.0, 0.5]).build()
    rmse = RegressionEvaluator(labelCol=label, metricName="rmse")
    pipe = Pipeline(stages=[*fill, VectorAssembler(inputCols=[f"__full_{c}" for c in numeric], outputCol="__features"), line])
    # every fold and point reads the rows again: only the columns used, once hashed
    train, test = (written(x, f"regression-{n}") for n, x in (("train", train.select(*numeric, label, "__fold")),
                                                              ("test", test.select(*numeric, label))))
    chosen = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=rmse, numFolds=folds,
                            foldCol="__fold").fit(train)
    best, scored = chosen.bestModel.stages[-1], chosen.transform(test)
    rows = [("fold mean rmse", ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda x: x[0].name)), float(m))
            for point, m in zip(grid, chosen.avgMetrics)]
    rows += [("parameter", p, float(best.getOrDefault(p))) for p in ("regParam", "elasticNetParam")]
    rows += [("coefficient", c, float(x)) for c, x in zip([*numeric, "intercept"], [*best.coefficients, best.intercept])]
    rows += [("held out", "rmse", float(rmse.evaluate(scored))),
             ("held out", "r2", float(RegressionEvaluator(labelCol=label, metricName="r2").evaluate(scored)))]
    return df.sparkSession.createDataFrame(rows, "part string, name string, value double")
