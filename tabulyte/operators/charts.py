"""The tables behind standard charts; nothing is drawn."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabulyte.functions.maths import normal_quantile
from tabulyte.operators.ordering import positions, quantiles, value_counts

GRID_POINTS = 200


def histogram(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the whole range, per class: count and density."""
    ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    width = (F.col("_e.hi") - F.col("_e.lo")) / bins
    b = F.least(F.floor(F.try_divide(F.col(value) - F.col("_e.lo"), width)), F.lit(bins - 1))
    counted = (
        df.filter(F.col(value).isNotNull()).withColumn("_e", ends)
        .groupBy(*keys, F.coalesce(b, F.lit(0)).cast("int").alias("bin"), F.col("_e.lo").alias("_lo"), width.alias("_w"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    from pyspark.sql import Window as W

    total = F.sum("n").over(W.partitionBy(*keys))
    return counted.select(
        *keys, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("left"), "n",
        (F.col("n") / (total * F.col("_w"))).alias("density"),
    )


def boxplot(df: DataFrame, value: str, key: str) -> DataFrame:
    """Quartiles, whiskers at the last values inside 1.5 IQR, and outliers per class."""
    q = quantiles(df, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75}, [key])
    span = 1.5 * (F.col("q3") - F.col("q1"))
    counts = value_counts(df, value, [key]).join(q, key)
    low, high = F.col(value) < F.col("q1") - span, F.col(value) > F.col("q3") + span
    return counts.groupBy(key, "q1", "q2", "q3").agg(
        F.min(F.when(~low, F.col(value))).alias("whisker_low"), F.max(F.when(~high, F.col(value))).alias("whisker_high"),
        F.sum(F.when(low | high, F.col("n")).otherwise(0)).alias("outliers"), F.sum("n").alias("n"),
    )


def kde(df: DataFrame, value: str, key: str, points: int = GRID_POINTS, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per class on an even grid, Scott's bandwidth.

    Kernels are summed over distinct values; each task adds up the whole grid for the
    values it holds, so what is shuffled is one row per class, grid point and task.
    """
    stats = df.groupBy(F.col(key).alias("_k")).agg(
        F.count(value).alias("_n"), F.stddev_samp(value).alias("_sd"), F.min(value).alias("_lo"), F.max(value).alias("_hi")
    ).withColumn("_h", F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)))
    values = value_counts(df, value, [key]).join(stats, F.col(key) == F.col("_k"))
    start = F.col("_lo") - cut * F.col("_h")
    step = (F.col("_hi") - F.col("_lo") + 2 * cut * F.col("_h")) / (points - 1)
    placed = values.select(key, F.col(value).cast("double").alias("_v"), F.col("n").cast("double").alias("_c"), start.alias("_start"), step.alias("_step"), "_h")

    def kernels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for k, rows in batch.groupby(key):
                grid = rows["_start"].iloc[0] + np.arange(points) * rows["_step"].iloc[0]
                v, c, h = rows["_v"].to_numpy(), rows["_c"].to_numpy(), rows["_h"].iloc[0]
                for at in range(0, len(v), 10_000):
                    u = (grid[:, None] - v[None, at : at + 10_000]) / h
                    held[k] = held.get(k, 0.0) + np.exp(-u * u / 2) @ c[at : at + 10_000]
        for k, sums in held.items():
            yield pd.DataFrame({key: [k] * points, "i": np.arange(points), "_p": sums})

    kind = placed.schema[key].dataType.simpleString()
    sums = placed.mapInPandas(kernels, f"`{key}` {kind}, i int, _p double").groupBy(key, "i").agg(F.sum("_p").alias("_s"))
    grid = stats.select(F.col("_k"), start.alias("_start"), step.alias("_step"), "_n", "_h")
    x = F.col("_start") + F.col("i") * F.col("_step")
    return sums.join(grid, F.col(key) == F.col("_k")).select(
        key, "i", x.alias("x"), (F.col("_s") / (F.col("_n") * F.col("_h") * F.sqrt(2 * F.pi()))).alias("density")
    )


def violin(df: DataFrame, value: str, key: str, points: int = GRID_POINTS) -> DataFrame:
    """Density per class with the quartiles of the class."""
    return kde(df, value, key, points).join(
        quantiles(df, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75}, [key]), key
    )


def normal_fit(df: DataFrame, value: str, key: str, points: int = GRID_POINTS) -> DataFrame:
    """Normal density at the sample mean and deviation, over the range of a class."""
    s = df.groupBy(key).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_sd"), F.min(value).alias("_lo"),
                            F.max(value).alias("_hi"))
    long = s.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("_lo") + F.col("i") * (F.col("_hi") - F.col("_lo")) / (points - 1)
    u = (x - F.col("_m")) / F.col("_sd")
    return long.select(key, "i", x.alias("x"), (F.exp(-u * u / 2) / (F.col("_sd") * F.sqrt(2 * F.pi()))).alias("density"))


def qq(df: DataFrame, value: str, ids: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Ordered values against normal quantiles of their median plotting positions."""
    rows = df.filter(F.col(value).isNotNull())
    ranked = positions(rows, [value, *ids], keys, name="i", totals=True)
    n, i = F.col("i_total"), F.col("i")
    tail = F.pow(F.lit(0.5), 1.0 / n)
    at = F.when(i == n, tail).when(i == 1, 1 - tail).otherwise((i - 0.3175) / (n + 0.365))
    return ranked.withColumn("_at", at).select(
        *keys, *ids, value, F.col("_at").alias("position"), normal_quantile("_at").alias("theoretical")
    )


def marked_points(df: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    """A series with the flagged points marked."""
    return df.join(flags.select(key, F.lit(True).alias("flagged")), key, "left").na.fill(False, ["flagged"])


def heatmap(df: DataFrame, row: Column, col: Column, value: Column) -> DataFrame:
    return df.groupBy(row.alias("row"), col.alias("col")).agg(value.alias("value"))
