"""Model queries over labelled documents, embeddings and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.functions import text as tx
from tabulyte.operators import models as mo, text_model
from tabulyte.operators.extra_trees import fit_extra_trees, score_trees
from tabulyte.operators.neighbours import smote
from tabulyte.operators.prep import split_stratified
from tabulyte.plans.evaluation import FLAGGED_SQL, flagged
from tabulyte.plans.registry import query
from tabulyte.plans.stand_ins import SCORED_SQL
from tabulyte.session import landing_path
from tabulyte.streaming.scoring import score_stream

FEATURES = ["text_len", "word_count", "has_url", "has_question", "has_exclaim", "caps_ratio", "has_emoji"]
LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def labelled_features(t):
    """One row per labelled document: id, text features, quality as y."""
    block = t.spread("documents").select("doc_id", *tx.feature_block("text"))
    return block.join(t.labels.select("doc_id", F.col("quality").cast("int").alias("y")), "doc_id").select(
        "doc_id", "y", *[F.col(c).cast("double").alias(c) for c in FEATURES]
    )


def parts(t):
    rows = mo.training_rows(split_stratified(labelled_features(t), ["doc_id"], "y"))
    return rows.filter(~F.col("is_test")), rows.filter("is_test")


def scored_by(t, estimator, scale=True):
    train, test = parts(t)
    return mo.score(mo.fit(train, mo.feature_stages(FEATURES, scale), estimator), test, ["doc_id", "y"])


@query("ml_logistic")
def ml_logistic(t):
    return scored_by(t, mo.logistic("y", "l1"))


@query("ml_odds_ratio")
def ml_odds_ratio(t):
    train, _ = parts(t)
    return mo.coefficients(mo.fit(train, mo.feature_stages(FEATURES), mo.logistic("y")), FEATURES, t.spark).limit(10)


@query("ml_random_forest")
def ml_random_forest(t):
    return scored_by(t, mo.random_forest("y"), scale=False)


@query("ml_extra_trees")
def ml_extra_trees(t):
    train, test = parts(t)
    return score_trees(fit_extra_trees(train, FEATURES, "y"), test, FEATURES, ["doc_id", "y"])


@query("ml_gbt")
def ml_gbt(t):
    return scored_by(t, mo.gradient_boosting("y"), scale=False)


@query("ml_naive_bayes")
def ml_naive_bayes(t):
    return scored_by(t, mo.naive_bayes("y"), scale=False)


@query("ml_linear_svm")
def ml_linear_svm(t):
    return scored_by(t, mo.linear_svm("y"))


@query("ml_cross_validate")
def ml_cross_validate(t):
    return mo.cross_validate(
        labelled_features(t), mo.feature_stages(FEATURES), mo.logistic("y"), "doc_id", "y", folds=5,
        resample=lambda train: smote(train, "doc_id", FEATURES, "y"),
    )


@query("ml_model_compare")
def ml_model_compare(t):
    train, test = parts(t)
    scaled, plain = mo.feature_stages(FEATURES), mo.feature_stages(FEATURES, scale=False)
    return mo.compare(train, test, {
        "logistic": (scaled, mo.logistic("y")), "random_forest": (plain, mo.random_forest("y")),
        "gradient_boosting": (plain, mo.gradient_boosting("y")), "linear_svm": (scaled, mo.linear_svm("y")),
    }, "doc_id", "y")


@query("ml_class_weighted")
def ml_class_weighted(t):
    train, test = parts(t)
    train = mo.balanced(train, "y")
    scaled, plain = mo.feature_stages(FEATURES), mo.feature_stages(FEATURES, scale=False)
    return mo.compare(train, test, {
        "logistic": (scaled, mo.logistic("y", weightCol="weight")), "random_forest": (plain, mo.random_forest("y", weightCol="weight")),
        "gradient_boosting": (plain, mo.gradient_boosting("y", weightCol="weight")),
    }, "doc_id", "y")


@query("ml_smote_compare")
def ml_smote_compare(t):
    train, test = parts(t)
    more = mo.training_rows(smote(train.select("doc_id", "y", *FEATURES), "doc_id", FEATURES, "y"))
    plain = mo.feature_stages(FEATURES, scale=False)
    return mo.compare(more, test, {"random_forest": (plain, mo.random_forest("y")), "gradient_boosting": (plain, mo.gradient_boosting("y"))}, "doc_id", "y")


@query("ml_text_benchmark")
def ml_text_benchmark(t):
    docs = t.spread("documents").select("doc_id", "text").join(t.labels.select("doc_id", F.col("quality").cast("int").alias("y")), "doc_id")
    models = {"logistic": mo.logistic("y"), "naive_bayes": mo.naive_bayes("y"), "linear_svm": mo.linear_svm("y")}
    return text_model.benchmark(docs, models, "doc_id", "y", max_features=35_000, bigrams=True)


@query("ml_hyperparam_search")
def ml_hyperparam_search(t):
    train, _ = parts(t)
    return mo.search(train, mo.feature_stages(FEATURES, scale=False), "y", "doc_id")


@query("ml_multiclass")
def ml_multiclass(t):
    rows = t.embeddings.select("vec_id", F.pmod("label", F.lit(3)).alias("y"), *[
        F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)
    ])
    dealt = mo.training_rows(split_stratified(rows, ["vec_id"], "y"))
    stages = mo.feature_stages([f"e{i}" for i in range(64)], scale=False)
    return mo.multiclass(dealt.filter(~F.col("is_test")), stages, dealt.filter("is_test"), "vec_id", "y", 3)


@query("ml_pca")
def ml_pca(t):
    return mo.principal_components(t.lineitem.select(*LINES), LINES, 3)[1]


@query("ml_kmeans")
def ml_kmeans(t):
    rows = t.embeddings.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    return mo.clusters(rows, [f"e{i}" for i in range(64)], "vec_id", 4, 3)


@query("ml_tree_rules")
def ml_tree_rules(t):
    return mo.tree_rules(mo.training_rows(labelled_features(t)), FEATURES, "y", 3)


@query("ml_learning_curve")
def ml_learning_curve(t):
    return mo.learning_curve(labelled_features(t), mo.feature_stages(FEATURES), mo.logistic("y"), "doc_id", "y")


@query(
    "ml_error_sample",
    f"""WITH e AS (SELECT id, y, pred, p FROM {FLAGGED_SQL} WHERE y <> pred)
        SELECT id, y, pred::BIGINT AS pred, p, (SELECT count(*) FROM e) AS errors,
               (SELECT count(*) FROM e) / (SELECT count(*) FROM {SCORED_SQL}) AS error_rate
        FROM e ORDER BY (id % 1000003) * 7919 % 10007, id LIMIT 12""",
    {8: "error_rate"},
)
def ml_error_sample(t):
    order = (F.col("id") % 1000003) * 7919 % 10007
    return mo.errors(flagged(t).select("id", "y", "pred", "p"), ["id"], "y", "pred", 12, order)


@query("ml_feature_importance")
def ml_feature_importance(t):
    train, _ = parts(t)
    model = mo.fit(train, mo.feature_stages(FEATURES, scale=False), mo.random_forest("y"))
    return mo.importances(model, FEATURES, t.spark, 5)


@query("ml_permutation_importance")
def ml_permutation_importance(t):
    train, test = parts(t)
    model = mo.fit(train, mo.feature_stages(FEATURES), mo.logistic("y"))
    return mo.permutation_importance(model, test, FEATURES, "doc_id", "y", repeats=10)


COEF = {"l_quantity": 0.02, "l_extendedprice": -0.00001, "l_discount": 3.0, "l_tax": -1.5}


@query(
    "ml_shap_linear",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(abs({b} * ({c} - (SELECT avg({c}) FROM lineitem)))) AS mean_abs FROM lineitem" for c, b in COEF.items()
    ),
    {8: "mean_abs"},
)
def ml_shap_linear(t):
    rows = t.lineitem.select(F.struct("l_orderkey", "l_linenumber").alias("id"), *COEF)
    return mo.mean_absolute(mo.linear_contributions(rows, COEF, "id"))


@query("ml_shap_sampled")
def ml_shap_sampled(t):
    train, test = parts(t)
    model = mo.fit(train, mo.feature_stages(FEATURES, scale=False), mo.random_forest("y"))
    return mo.mean_absolute(mo.sampled_shapley(model, test, FEATURES, "doc_id"))


@query("ml_counterfactual")
def ml_counterfactual(t):
    train, test = parts(t)
    model = mo.fit(train, mo.feature_stages(FEATURES), mo.logistic("y"))
    top = [r.feature for r in mo.importances(model, FEATURES, t.spark, 3).collect()]
    return mo.counterfactuals(model, test, FEATURES, "doc_id", "y", top)


def saved_text_model(t):
    """A text model of document quality, trained and saved in the shared folder."""
    rows = t.spread("documents").select("doc_id", "text").join(t.labels.select("doc_id", F.col("quality").cast("int").alias("y")), "doc_id")
    path = landing_path(t.spark, "text-model")
    text_model.fit_text_model(rows, mo.logistic("y"), max_features=35_000, bigrams=True).write().save(path)
    return path


@query("ml_score_text")
def ml_score_text(t):
    from pyspark.ml import PipelineModel

    model = PipelineModel.load(saved_text_model(t))
    return text_model.score_text(model, t.spread("conversations", "conv_id"), ["conv_id", "turn"])


@query("stream_score_text")
def stream_score_text(t):
    out = score_stream(
        t.spark, f"{t.folder}/conversations.parquet", t.conversations.schema, saved_text_model(t), ["conv_id", "turn"],
        landing_path(t.spark, "scored"), landing_path(t.spark, "stream"),
    )
    return t.spark.read.parquet(out)
