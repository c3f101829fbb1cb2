"""Scaling, splits, folds and weights that are the same on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabulyte.operators.hypothesis import anova
from tabulyte.operators.ordering import melt, positions, quantiles
from tabulyte.operators.sampling import hashed
from tabulyte.session import written


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std, with statistics of `fit_on` (the training rows)."""
    base = df if fit_on is None else fit_on
    stats = base.agg(F.struct(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols)
                                for n, f in (("m", F.avg), ("s", F.stddev_pop))])).scalar()
    return df.withColumn("_s", stats).withColumns({
        c: F.coalesce(F.try_divide(F.col(c) - F.col(f"_s.m{i}"), F.col(f"_s.s{i}")), F.col(c) - F.col(f"_s.m{i}"))
        for i, c in enumerate(cols)
    }).drop("_s")


def robust_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - median) / interquartile range, from exact quantiles."""
    base = df if fit_on is None else fit_on
    q = quantiles(melt(base, cols), "value", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, ["feature"])
    stats = q.agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct("q1", "q2", "q3"))))).scalar()
    at = lambda c, k: F.col("_s")[c][k]
    return df.withColumn("_s", stats).withColumns({
        c: F.coalesce(F.try_divide(F.col(c) - at(c, "q2"), at(c, "q3") - at(c, "q1")), F.col(c) - at(c, "q2"))
        for c in cols
    }).drop("_s")


def split_stratified(df: DataFrame, ids: Sequence[str], label: str, test: float = 0.2, order: Column | None = None,
                     seed: int = 42) -> DataFrame:
    """Mark the first share of each class, in hash order, as test rows."""
    key = hashed(ids, seed) if order is None else order
    ranked = positions(df.withColumn("_h", key), ["_h", *ids], [label], name="_pos", totals=True)
    cut = F.floor(F.col("_pos_total") * test + 0.5)
    return ranked.withColumn("is_test", F.col("_pos") <= cut).drop("_h", "_pos", "_pos_total")


def kfold_stratified(df: DataFrame, ids: Sequence[str], label: str, k: int = 5, order: Column | None = None,
                     seed: int = 42) -> DataFrame:
    """Deal the rows of each class, in hash order, to k folds in turn."""
    key = hashed(ids, seed) if order is None else order
    ranked = positions(df.withColumn("_h", key), ["_h", *ids], [label], name="_pos")
    return ranked.withColumn("fold", ((F.col("_pos") - 1) % k).cast("int")).drop("_h", "_pos")


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (classes * rows of the class) on every row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("k"))
    counts = written(counts, "classes")
    one = counts.agg(F.struct(F.sum("k").alias("n"), F.count(F.lit(1)).alias("c"))).scalar()
    weights = counts.withColumn("_w", one).select(F.col(label).alias("_class"), (F.col("_w.n") / (F.col("_w.c") * F.col("k"))).alias(name))
    return df.join(weights, F.col(label).eqNullSafe(F.col("_class"))).drop("_class")


def positive_weight(df: DataFrame, label: str) -> DataFrame:
    positives = F.count_if(F.col(label) == 1)
    return df.agg(F.try_divide(F.count(F.lit(1)) - positives, positives).alias("scale_pos_weight"))


def select_k_best(df: DataFrame, features: Sequence[str], label: str, k: int) -> DataFrame:
    """The k features with the largest ANOVA F."""
    return anova(df, features, label).orderBy(F.desc("f"), "feature").limit(k)
