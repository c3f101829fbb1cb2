"""Exact evaluation metrics of scores and predictions.

Curves, AUC and average precision are running sums over distinct scores; counts
at fixed thresholds come from a 101-step histogram.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.operators.joins import threshold_counts
from tabulyte.operators.ordering import running


def confusion(df: DataFrame, label: str = "y", pred: str = "pred") -> DataFrame:
    """Counts per actual and predicted class, and the percentage of the actual class."""
    cells = df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumn("row_pct", F.col("n") * 100.0 / F.sum("n").over(W.partitionBy("actual")))


def class_report(df: DataFrame, label: str = "y", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class, then the averages."""
    cells = df.groupBy(F.col(label).cast("string").alias("a"), F.col(pred).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    both = cells.select(
        F.explode(F.array(
            F.struct(F.col("a").alias("c"), F.lit(1).alias("is_a"), F.lit(0).alias("is_p")),
            F.struct(F.col("p").alias("c"), F.lit(0).alias("is_a"), F.lit(1).alias("is_p")),
        )).alias("e"),
        "n", (F.col("a") == F.col("p")).alias("hit"),
    )
    sums = both.groupBy(F.col("e.c").alias("name")).agg(
        F.sum(F.col("e.is_a") * F.col("n")).alias("support"), F.sum(F.col("e.is_p") * F.col("n")).alias("_p"),
        F.sum(F.when(F.col("hit"), F.col("e.is_a") * F.col("n")).otherwise(0)).alias("_tp"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    per = sums.withColumns({
        "precision": zero(F.try_divide(F.col("_tp"), F.col("_p"))),
        "recall": zero(F.try_divide(F.col("_tp"), F.col("support"))),
    }).withColumn("f1", zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))
    names = ("precision", "recall", "f1")
    accuracy = F.sum("_tp") / F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("name"), *[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("name"),
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    overall = per.agg(F.lit("accuracy").alias("name"), *[accuracy.alias(c) for c in names], F.sum("support").alias("support"))
    head = per.select("name", *names, "support")
    return head.unionByName(macro).unionByName(weighted).unionByName(overall)


def binary_from_counts(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rates from `tp`, `fp`, `fn`, `tn`; undefined ones are 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return counts.select(
        *keys, "tp", "fp", "fn", "tn",
        zero(F.try_divide(tp + tn, tp + fp + fn + tn)).alias("accuracy"),
        zero(F.try_divide(tp, tp + fp)).alias("precision"),
        zero(F.try_divide(tp, tp + fn)).alias("recall"),
        zero(F.try_divide(2 * tp, 2 * tp + fp + fn)).alias("f1"),
        zero(F.try_divide(tn, tn + fp)).alias("specificity"),
        zero(F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))).alias("mcc"),
    )


def confusion_counts(df: DataFrame, label: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy(*keys).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    )


def binary(df: DataFrame, label: str = "y", pred: str = "pred", keys: Sequence[str] = ()) -> DataFrame:
    return binary_from_counts(confusion_counts(df, label, pred, keys), keys)


def score_table(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct scores with `n1` positives of `n` rows, running sums from the
    highest score down, and the totals."""
    counts = df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("n1"), F.count(F.lit(1)).alias("n")
    )
    return running(counts, ["score"], {"tp": ("sum", "n1"), "all": ("sum", "n")}, keys, reverse=True, totals=True)


def roc_curve(df: DataFrame, label: str = "y", score: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    s = score_table(df, label, score, keys)
    fp, neg = F.col("all") - F.col("tp"), F.col("all_total") - F.col("tp_total")
    return s.select(*keys, "score", F.try_divide(fp, neg).alias("fpr"), F.try_divide(F.col("tp"), F.col("tp_total")).alias("tpr"))


def roc_auc(df: DataFrame, label: str = "y", score: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve; rows with one score count as half ordered."""
    s = score_table(df, label, score, keys)
    positives_above = F.col("tp") - F.col("n1")
    won = (F.col("n") - F.col("n1")).cast("double") * (positives_above + F.col("n1") / 2)
    pairs = F.max("tp_total").cast("double") * F.max(F.col("all_total") - F.col("tp_total"))
    return s.groupBy(*keys).agg(F.try_divide(F.sum(won), pairs).alias("auc"))


def roc_auc_ovr(df: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """Unweighted mean of the one-versus-rest areas; `scores` maps class to column."""
    entry = F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), (F.col(label) == k).cast("int").alias("y"), F.col(c).alias("p"))
        for k, c in scores.items()
    ])).alias("e")
    return roc_auc(df.select(entry).select("e.*"), "y", "p", ["k"]).agg(F.avg("auc").alias("auc"))


def pr_curve(df: DataFrame, label: str = "y", score: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at each score, with the share of positives."""
    s = score_table(df, label, score, keys)
    return s.select(
        *keys, "score", (F.col("tp") / F.col("all")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("tp_total")).alias("recall"),
        (F.col("tp_total") / F.col("all_total")).alias("prevalence"),
    )


def average_precision(df: DataFrame, label: str = "y", score: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    """Sum of precision times the step in recall."""
    s = score_table(df, label, score, keys)
    step = F.try_divide(F.col("n1"), F.col("tp_total")) * F.col("tp") / F.col("all")
    return s.groupBy(*keys).agg(F.sum(step).alias("average_precision"))


def brier(df: DataFrame, label: str = "y", score: str = "p", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def calibration(df: DataFrame, label: str = "y", score: str = "p", bins: int = 10) -> DataFrame:
    """Mean predicted and observed rate in equal-width bins that hold rows."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1))
    return df.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("predicted"), F.avg(F.col(label).cast("double")).alias("observed")
    )


def threshold_sweep(df: DataFrame, label: str = "y", score: str = "p", lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Accuracy, F1 and recall at every hundredth between two thresholds."""
    counts = threshold_counts(df, score, label).filter(F.col("threshold").between(lo, hi))
    return binary_from_counts(counts, ["threshold"]).select("threshold", "accuracy", "precision", "recall", "f1")


def best_f1_threshold(df: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """The score cut with the largest F1; the lowest cut wins a tie."""
    s = score_table(df, label, score)
    f1 = F.round(2.0 * F.col("tp") / (F.col("all") + F.col("tp_total")), 12)
    best = F.max_by(F.struct("score", "f1", "precision", "recall"), F.struct("f1", -F.col("score"))).alias("b")
    return (
        s.withColumns({"f1": f1, "precision": F.col("tp") / F.col("all"), "recall": F.col("tp") / F.col("tp_total")})
        .agg(best).select(F.col("b.score").alias("threshold"), "b.f1", "b.precision", "b.recall")
    )


def cost_curve(df: DataFrame, cost: Column, label: str = "y", score: str = "p", lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Cost, an expression over tp, fp, fn and tn, at every hundredth."""
    counts = threshold_counts(df, score, label).filter(F.col("threshold").between(lo, hi))
    return counts.withColumn("cost", cost)


def cost_threshold(df: DataFrame, c_fn: float = 100_000.0, c_fp: float = 5_000.0, label: str = "y", score: str = "p",
                   default: float = 0.5) -> DataFrame:
    """Cheapest threshold, its cost, and the saving against the default one."""
    curve = cost_curve(df, F.col("fn") * c_fn + F.col("fp") * c_fp, label, score)
    return _cheapest(curve, default)


def cost_benefit(df: DataFrame, label: str = "y", score: str = "p", c_fn: float = 50_000.0, c_fp: float = 5_000.0,
                 gain_tp: float = 45_000.0, default: float = 0.5) -> DataFrame:
    """As `cost_threshold`, crediting each event caught, between 0.05 and 0.95."""
    cost = F.col("fn") * c_fn + F.col("fp") * c_fp - F.col("tp") * gain_tp
    return _cheapest(cost_curve(df, cost, label, score, 0.05, 0.95), default)


def _cheapest(curve: DataFrame, default: float) -> DataFrame:
    return curve.agg(
        F.min_by("threshold", F.struct("cost", "threshold")).alias("threshold"), F.min("cost").alias("cost"),
        F.max(F.when(F.col("threshold") == default, F.col("cost"))).alias("default_cost"),
    ).withColumn("saving", F.col("default_cost") - F.col("cost"))


def cost_matrix(df: DataFrame, costs: Mapping[tuple[str, str], float], label: str = "y", pred: str = "pred",
                keys: Sequence[str] = ()) -> DataFrame:
    """Total cost per actual class and overall, from a fixed cost per cell."""
    cells = df.groupBy(*keys, F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    pairs = [x for (a, p), c in costs.items() for x in (F.lit(f"{a}\t{p}"), F.lit(float(c)))]
    price = F.try_element_at(F.create_map(*pairs), F.concat_ws("\t", "actual", "predicted"))
    spent = cells.withColumn("cost", F.col("n") * price)
    per = spent.groupBy(*keys, "actual").agg(F.sum("cost").alias("cost"))
    total = per.groupBy(*keys).agg(F.lit("total").alias("actual"), F.sum("cost").alias("cost"))
    return per.unionByName(total)
