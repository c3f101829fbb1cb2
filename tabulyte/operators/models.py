"""Model training on MLlib, with exact metrics and repeatable resampling."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tabulyte.operators import metrics as me
from tabulyte.operators.ordering import positions
from tabulyte.operators.prep import kfold_stratified
from tabulyte.operators.sampling import hashed
from tabulyte.session import written

SEED = 42
#: Fits that run side by side: their many short jobs fill each other's gaps.
FITS = 6
#: Rows of a task at least, in boosting: its hundreds of passes cost more to start than to run.
BOOSTING_ROWS = 20_000


def feature_stages(features: Sequence[str], scale: bool = True) -> list:
    """Assemble, and standardise with the statistics of the rows fitted on."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="raw" if scale else "features")]
    if scale:
        stages.append(StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True))
    return stages


def logistic(label: str, penalty: str = "l2", strength: float = 0.01, **kw) -> LogisticRegression:
    """Ridge (`l2`) or lasso (`l1`) logistic; `strength` is 1 / (C * rows)."""
    return LogisticRegression(labelCol=label, regParam=strength, elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              standardization=False, maxIter=kw.pop("maxIter", 100), **kw)


def random_forest(label: str, trees: int = 150, depth: int = 6, **kw) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=SEED, **kw)


def gradient_boosting(label: str, rounds: int = 100, depth: int = 3, **kw) -> GBTClassifier:
    return GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=SEED, **kw)


def naive_bayes(label: str, smoothing: float = 1.0, **kw) -> NaiveBayes:
    return NaiveBayes(labelCol=label, modelType="multinomial", smoothing=smoothing, **kw)


def linear_svm(label: str, strength: float = 0.01, **kw) -> LinearSVC:
    return LinearSVC(labelCol=label, regParam=strength, maxIter=50, **kw)


def training_rows(df: DataFrame) -> DataFrame:
    """Keep the rows for the passes of an iterative fit, until they are `released`.
    Adaptive execution joins the small partitions of a shuffled input."""
    kept = df.persist()
    kept.count()
    return kept


def released(df: DataFrame) -> None:
    """Let go of rows kept by `training_rows`."""
    df.unpersist()


def together(spark, tasks: Sequence[Callable], width: int = FITS) -> list:
    """The results of independent tasks, in order, `width` of them at a time."""
    if not tasks:
        return []
    with ThreadPool(min(width, len(tasks))) as pool:
        return pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks, chunksize=1)


def balanced(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add the weight rows / (classes * rows of the class), for `weightCol`."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.struct(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    weights = counts.withColumn("_t", total).select(F.col(label).alias("_label"), (F.col("_t.n") / (F.col("_t.k") * F.col("_n"))).alias(name))
    return df.join(weights, F.col(label) == F.col("_label")).drop("_label")


def fit(train: DataFrame, stages: Sequence, estimator) -> PipelineModel:
    if isinstance(estimator, GBTClassifier):
        train = train.coalesce(train.count() // BOOSTING_ROWS + 1)
    return Pipeline(stages=[*stages, estimator]).fit(train)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns with the score of class 1 and the prediction.

    Margins of a linear classifier without probabilities serve as its scores.
    """
    out = model.transform(df)
    source = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(*keep, vector_to_array(source)[1].alias("p"), F.col("prediction").cast("int").alias("pred"))


def metric_table(scored: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """AUC, average precision, and the rates of the predictions, per key."""
    auc = me.roc_auc(scored, label, "p", keys)
    ap = me.average_precision(scored, label, "p", keys)
    rates = me.binary(scored, label, "pred", keys).select(*keys, "accuracy", "precision", "recall", "f1", "mcc")
    return auc.join(ap, list(keys)).join(rates, list(keys))


def compare(train: DataFrame, test: DataFrame, models: Mapping[str, tuple[Sequence, object]], id_col: str,
            label: str) -> DataFrame:
    """Metrics of several models on the test rows, and which has the best F1."""
    tasks = [lambda s=stages, e=estimator: fit(train, s, e) for stages, estimator in models.values()]
    stacked = None
    for name, model in zip(models, together(train.sparkSession, tasks)):
        one = score(model, test, [id_col, label]).select(F.lit(name).alias("model"), "*")
        stacked = one if stacked is None else stacked.unionByName(one)
    table = metric_table(written(stacked, "scores"), label, ["model"])
    best = table.agg(F.max_by("model", F.struct("f1", "auc"))).scalar()
    return table.withColumn("_best", best).withColumn("best", F.col("model") == F.col("_best")).drop("_best")


def cross_validate(df: DataFrame, stages: Sequence, estimator, id_col: str, label: str, folds: int = 5,
                   resample: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Mean and standard deviation over folds of AUC, AP and F1.

    Scaling, and oversampling where asked for, see the training folds only.
    """
    dealt = written(kfold_stratified(df, [id_col], label, folds), "folds")
    stacked = None
    for k in range(folds):
        train = dealt.filter(F.col("fold") != k).drop("fold")
        train = training_rows(resample(train) if resample else train)
        model = fit(train, stages, estimator)
        released(train)
        one = score(model, dealt.filter(F.col("fold") == k), [id_col, label, "fold"])
        stacked = one if stacked is None else stacked.unionByName(one)
    table = metric_table(written(stacked, "scores"), label, ["fold"])
    long = table.unpivot([], ["auc", "average_precision", "f1"], "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def learning_curve(df: DataFrame, stages: Sequence, estimator, id_col: str, label: str,
                   sizes: Sequence[float] = (0.1, 0.25, 0.4, 0.6, 0.8, 1.0), folds: int = 3) -> DataFrame:
    """Training and validation AUC at growing shares of the training folds."""
    dealt = kfold_stratified(df, [id_col], label, folds)
    placed = training_rows(dealt.withColumn("_u", F.pmod(hashed([id_col], SEED + 1), F.lit(1_000_000)) / 1_000_000.0))
    cells = [(size, k) for size in sizes for k in range(folds)]
    seen = lambda size, k: (F.col("fold") != k) & (F.col("_u") < size)
    tasks = [lambda size=size, k=k: fit(placed.filter(seen(size, k)), stages, estimator) for size, k in cells]
    stacked = None
    for (size, k), model in zip(cells, together(df.sparkSession, tasks)):
        part = F.when(F.col("fold") == k, "validation").otherwise("train").alias("part")
        rows = placed.filter(seen(size, k) | (F.col("fold") == k)).select("*", part)
        one = score(model, rows, ["part", label]).select(F.lit(size).alias("size"), F.lit(k).alias("fold"), "part", label, "p")
        stacked = one if stacked is None else stacked.unionByName(one)
    auc = me.roc_auc(written(stacked, "scores"), label, "p", ["size", "fold", "part"])
    released(placed)
    return auc.groupBy("size", "part").agg(F.avg("auc").alias("auc"), F.stddev_pop("auc").alias("std"))


def search(df: DataFrame, stages: Sequence, label: str, id_col: str, trials: int = 10, trees: Sequence[int] = (50, 100, 150, 200),
           depths: Sequence[int] = (2, 4, 6, 8)) -> DataFrame:
    """Random-forest settings scored by AUC on a quarter of the rows, chosen by a hash of
    the id; test rows play no part.  The settings tried are the first `trials` of the grid
    in the order of a digest, so a repeat tries the same."""
    grid = sorted(((n, d) for n in trees for d in depths), key=lambda s: hashlib.md5(f"{SEED}:{s}".encode()).hexdigest())[:trials]
    aside = F.pmod(hashed([id_col], SEED), F.lit(4)) == 0
    rows = written(df, "search")
    train, held = training_rows(rows.filter(~aside)), rows.filter(aside)
    stacked = None
    for n, d in grid:
        one = score(fit(train, stages, random_forest(label, n, d)), held, [label]).select(F.lit(n).alias("trees"), F.lit(d).alias("depth"), label, "p")
        stacked = one if stacked is None else stacked.unionByName(one)
    auc = me.roc_auc(written(stacked, "scores"), label, "p", ["trees", "depth"])
    released(train)
    return auc.select("trees", "depth", "auc").orderBy(F.desc("auc"), "trees", "depth")


def multiclass(df: DataFrame, stages: Sequence, test: DataFrame, id_col: str, label: str, classes: int) -> DataFrame:
    """Accuracy, macro F1 and one-versus-rest AUC of three multi-class models."""
    models = {
        "logistic": logistic(label, family="multinomial"),
        "random_forest": random_forest(label),
        "gradient_boosting": OneVsRest(labelCol=label, classifier=gradient_boosting(label, rounds=20)),
    }
    out = None
    for name, estimator in models.items():
        scored = fit(df, stages, estimator).transform(test)
        source = "probability" if "probability" in scored.columns else "rawPrediction"
        rows = scored.select(
            F.col(label).cast("int").cast("string").alias("y"), F.col("prediction").cast("int").cast("string").alias("pred"),
            *[vector_to_array(source)[i].alias(f"p{i}") for i in range(classes)],
        )
        report = me.class_report(rows).filter(F.col("name").isin("macro avg", "accuracy"))
        auc = me.roc_auc_ovr(rows, "y", {str(i): f"p{i}" for i in range(classes)})
        one = report.agg(
            F.max(F.when(F.col("name") == "accuracy", F.col("f1"))).alias("accuracy"),
            F.max(F.when(F.col("name") == "macro avg", F.col("f1"))).alias("macro_f1"),
        ).withColumn("auc_ovr", auc.scalar()).select(F.lit(name).alias("model"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def coefficients(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """Coefficient and odds ratio per feature, largest effect first."""
    import math

    values = model.stages[-1].coefficients.toArray()
    rows = [(c, float(v), math.exp(float(v))) for c, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, coef double, odds_ratio double").orderBy(
        F.desc(F.abs("coef")), "feature"
    )


def importances(model: PipelineModel, features: Sequence[str], spark, k: int | None = None) -> DataFrame:
    """Gini importances of a tree model, or absolute coefficients of a linear one."""
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    rows = [(c, float(v)) for c, v in zip(features, values)]
    table = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return table.limit(k) if k else table


def principal_components(df: DataFrame, features: Sequence[str], k: int) -> tuple[PipelineModel, DataFrame]:
    """Components of the standardised features; variance and top loadings per component."""
    pca = PCA(k=k, inputCol="features", outputCol="pc")
    model = Pipeline(stages=[*feature_stages(features), pca]).fit(df)
    last = model.stages[-1]
    ratios, load = last.explainedVariance.toArray(), last.pc.toArray()
    rows = []
    for i in range(k):
        top = sorted(zip(features, load[:, i]), key=lambda p: -abs(p[1]))[:3]
        rows.append((i + 1, float(ratios[i]), float(ratios[: i + 1].sum()), ", ".join(c for c, _ in top)))
    table = df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double, top_features string")
    return model, table


def clusters(df: DataFrame, features: Sequence[str], id_col: str, k: int = 4, components: int = 3) -> DataFrame:
    """`(id, cluster, profile)`: k-means on the leading components."""
    stages = [*feature_stages(features), PCA(k=components, inputCol="features", outputCol="pc"),
              KMeans(k=k, featuresCol="pc", predictionCol="cluster", seed=SEED, maxIter=20)]
    scored = Pipeline(stages=stages).fit(df).transform(df)
    return scored.select(id_col, "cluster", F.concat(F.lit("Profile "), F.col("cluster").cast("string")).alias("profile"))


def tree_rules(df: DataFrame, features: Sequence[str], label: str, depth: int = 3) -> DataFrame:
    """A shallow tree as one rule per leaf, with the rows and rate of the leaf."""
    tree = DecisionTreeClassifier(labelCol=label, maxDepth=depth, leafCol="leaf", seed=SEED)
    model = fit(df, feature_stages(features, scale=False), tree)
    rules: list[tuple[int, str, int]] = []

    def walk(node, path: list[str]) -> None:
        if node.subtreeDepth() == 0:
            rules.append((len(rules), " AND ".join(path) or "always", int(node.prediction())))
            return
        name, at = features[node.split().featureIndex()], node.split().threshold()
        walk(node.leftChild(), [*path, f"{name} <= {at:.4f}"])
        walk(node.rightChild(), [*path, f"{name} > {at:.4f}"])

    walk(model.stages[-1]._java_obj.rootNode(), [])
    table = df.sparkSession.createDataFrame(rules, "leaf_no int, rule string, predicted int")
    counts = model.transform(df).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("rate")
    )
    return table.join(counts, F.col("leaf_no") == F.col("leaf"), "left").select("rule", "predicted", "n", "rate")


def errors(scored: DataFrame, ids: Sequence[str], label: str, pred: str, k: int, order=None) -> DataFrame:
    """The first misclassified rows in hash order, with the count and rate of all."""
    wrong = F.col(label) != F.col(pred)
    totals = scored.agg(F.struct(F.count_if(wrong).alias("errors"), F.avg(wrong.cast("double")).alias("error_rate"))).scalar()
    key = hashed(ids) if order is None else order
    return scored.filter(wrong).withColumn("_h", key).orderBy("_h", *ids).limit(k).drop("_h").withColumn(
        "_t", totals
    ).select("*", "_t.errors", "_t.error_rate").drop("_t")


def permuted_pairs(df: DataFrame, id_col: str, features: Sequence[str], repeats: int, seed: int = SEED) -> DataFrame:
    """Each row, once per repeat, with the features of another row: a hashed
    permutation per repeat, all of them found in one ordered pass."""
    values = F.struct(*[F.col(c).cast("double").alias(c) for c in features]).alias("other")
    dealt = df.select(id_col, values).withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    there = positions(dealt.withColumn("_h", F.xxhash64(id_col, "repeat", F.lit(seed))), ["_h", id_col], ["repeat"], name="_p")
    here = positions(df.select(F.col(id_col).alias("_id")), ["_id"], name="_p")
    pairs = here.join(there.select("repeat", "other", "_p"), "_p").select("_id", "repeat", "other")
    return df.join(pairs, F.col(id_col) == F.col("_id")).drop("_id")


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], id_col: str, label: str,
                           repeats: int = 10) -> DataFrame:
    """Loss of AUC when one column is shuffled: mean and deviation over repeats.

    A repeat pairs every row with another one and derives all column variants from
    that pair, so the model scores everything in one pass.
    """
    rows = df.select(id_col, label, *[F.col(c).cast("double").alias(c) for c in features])
    base = me.roc_auc(score(model, rows, [label]), label, "p").scalar()
    variants = permuted_pairs(rows, id_col, features, repeats).withColumn("feature", F.explode(F.lit(list(features))))
    swapped = variants.select("repeat", "feature", label, *[
        F.when(F.col("feature") == c, F.col(f"other.{c}")).otherwise(F.col(c)).alias(c) for c in features
    ])
    scored = written(score(model, swapped, ["repeat", "feature", label]), "permuted")
    auc = me.roc_auc(scored, label, "p", ["repeat", "feature"])
    drop = auc.withColumn("_base", base).withColumn("drop", F.col("_base") - F.col("auc"))
    return drop.groupBy("feature").agg(F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std"))


def linear_contributions(df: DataFrame, coef: Mapping[str, float], id_col: str) -> DataFrame:
    """Additive contribution `coef * (x - mean)` per row and feature."""
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in coef])).scalar()
    wide = df.withColumn("_m", means).select(
        id_col, *[(F.lit(float(b)) * (F.col(c) - F.col(f"_m.{c}"))).alias(c) for c, b in coef.items()]
    )
    return wide.unpivot([id_col], list(coef), "feature", "contribution")


def mean_absolute(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature; where contributions are sampled, with the
    root mean square of their standard errors."""
    error = [F.sqrt(F.avg(F.col("std_error") * F.col("std_error"))).alias("std_error")] if "std_error" in contributions.columns else []
    return contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"), *error).orderBy(
        F.desc("mean_abs"), "feature"
    )


def sampled_shapley(model: PipelineModel, df: DataFrame, features: Sequence[str], id_col: str, orders: int = 8) -> DataFrame:
    """Shapley contributions of any model from sampled feature orders: `contribution`, and
    `std_error`, its standard error over the orders.

    In each order the row's values replace those of a random other row one by
    one; a feature's contribution is the change of score at its turn.
    """
    p = len(features)
    rows = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in features])
    turn = F.array_sort(F.array(*[
        F.struct(F.xxhash64(id_col, "order", F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(p)
    ]))
    paired = permuted_pairs(rows, id_col, features, orders).withColumnRenamed("repeat", "order").withColumn(
        "_turn", F.transform(turn, lambda s: s["i"])
    )
    steps = paired.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(p))))
    mixed = steps.select(id_col, "order", "step", "_turn", *[
        F.when(F.array_position("_turn", F.lit(i)) <= F.col("step"), F.col(c)).otherwise(F.col(f"other.{c}")).alias(c)
        for i, c in enumerate(features)
    ])
    scored = score(model, mixed, [id_col, "order", "step", "_turn"])
    per_order = scored.groupBy(id_col, "order").agg(
        F.sort_array(F.collect_list(F.struct("step", "p"))).alias("path"), F.first("_turn").alias("_turn")
    )
    change = F.transform(F.sequence(F.lit(1), F.lit(p)), lambda k: F.struct(
        F.element_at("_turn", k).alias("i"),
        (F.element_at("path", k + 1)["p"] - F.element_at("path", k)["p"]).alias("v"),
    ))
    names = F.lit(list(features))
    return per_order.select(id_col, F.explode(change).alias("c")).groupBy(
        id_col, F.element_at(names, F.col("c.i") + 1).alias("feature")
    ).agg(F.avg("c.v").alias("contribution"), (F.stddev_samp("c.v") / F.sqrt(F.count("c.v"))).alias("std_error"))


def counterfactuals(model: PipelineModel, df: DataFrame, features: Sequence[str], id_col: str, label: str,
                    top: Sequence[str], start: float = 0.75, target: float = 0.20, growth: float = 1.03,
                    steps: int = 30) -> DataFrame:
    """For confident true positives, the first step of scaling the top features at
    which the score falls to the target; null when no step does."""
    rows = df.select(id_col, label, *[F.col(c).cast("double").alias(c) for c in features])
    risky = score(model, rows, rows.columns).filter((F.col("p") > start) & (F.col(label) == 1)).withColumnRenamed("p", "p_start")
    tried = risky.drop("pred").withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    scaled = tried.withColumns({c: F.col(c) * F.pow(F.lit(growth), F.col("step")) for c in top})
    scored = score(model, scaled, [id_col, "p_start", "step"])
    return scored.groupBy(id_col, "p_start").agg(
        F.min(F.when(F.col("p") <= target, F.col("step"))).alias("step"),
        F.min("p").alias("lowest_p"),
    )
