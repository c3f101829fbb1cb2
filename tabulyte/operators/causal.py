"""Propensity scores and matched-pair effects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, functions as F

from tabulyte.operators.hypothesis import mann_whitney_counts
from tabulyte.operators.joins import nearest_within
from tabulyte.session import written


def propensity(df: DataFrame, features: Sequence[str], treatment: str, name: str = "propensity") -> DataFrame:
    """Probability of treatment from a logistic model of the features."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_x"),
        StandardScaler(inputCol="_x", outputCol="_z", withMean=True),
        LogisticRegression(featuresCol="_z", labelCol=treatment, predictionCol="_pred", rawPredictionCol="_raw",
                           probabilityCol="_prob", maxIter=100),
    ]
    scored = Pipeline(stages=stages).fit(df).transform(df)
    return scored.withColumn(name, vector_to_array("_prob")[1]).drop("_x", "_z", "_pred", "_raw", "_prob")


def matched_effect(
    df: DataFrame, id_col: str, treatment: str, score: str, outcome: str, caliper: float = 0.05
) -> DataFrame:
    """Mean outcome of matched treated rows and of their controls, and the rank test.

    A control used many times is one row with a weight, so a control that suits a
    third of all treated rows does not become a hot join key.
    """
    rows = df.select(id_col, treatment, score, outcome)
    treated = rows.filter(F.col(treatment) == 1)
    control = rows.filter(F.col(treatment) == 0)
    pairs = written(nearest_within(treated, control.select(id_col, score), score, id_col, caliper), "pairs")
    uses = pairs.groupBy("control_id").agg(F.count(F.lit(1)).alias("w"))
    used = control.join(uses, control[id_col] == uses.control_id).select(
        F.lit(0).alias("side"), F.col(outcome).alias("v"), "w"
    )
    both = pairs.select(F.lit(1).alias("side"), F.col(outcome).alias("v"), F.lit(1).cast("bigint").alias("w")).unionByName(used)
    counts = both.groupBy("v").agg(
        F.sum(F.when(F.col("side") == 1, F.col("w")).otherwise(0)).alias("n1"), F.sum("w").alias("n")
    )
    test = mann_whitney_counts(counts, "v").select(F.struct("u", "z", "p_value")).scalar()
    part = lambda k: F.sum(F.when(F.col("side") == k, F.col("v") * F.col("w"))) / F.sum(F.when(F.col("side") == k, F.col("w")))
    effect = both.agg(
        F.sum(F.when(F.col("side") == 1, F.col("w"))).alias("pairs"),
        part(1).alias("treated_mean"), part(0).alias("control_mean"),
    )
    return effect.withColumn("difference", F.col("treated_mean") - F.col("control_mean")).withColumn(
        "_t", test
    ).select("pairs", "treated_mean", "control_mean", "difference", "_t.u", "_t.z", "_t.p_value")
