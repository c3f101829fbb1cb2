"""Counts, rates, summaries, crosstabs, correlations and fences.

Shares of a total are taken from the grouped rows, so the raw rows are shuffled
once, after partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.operators.ordering import melt, quantiles, value_counts

_MOMENTS = ("n", "x", "y", "xx", "yy", "xy")
QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def rows() -> Column:
    return F.count(F.lit(1))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(rows().alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns"))


def date_range(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("first"), F.max(col).alias("last"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Positives, negatives, rate, and negatives per positive."""
    pos = F.sum(F.col(label).cast("bigint"))
    neg = rows() - pos
    return df.agg(
        pos.alias("positives"), neg.alias("negatives"),
        F.avg(F.col(label).cast("double")).alias("rate"),
        F.try_divide(neg, pos).alias("imbalance"),
    )


def segment_ratio(df: DataFrame, segment: Column, value: str) -> DataFrame:
    """Mean of the rows in the segment, outside it, and the ratio of the two."""
    inside = F.avg(F.when(segment, F.col(value)))
    outside = F.avg(F.when(~segment, F.col(value)))
    return df.agg(
        inside.alias("inside"), outside.alias("outside"), F.try_divide(inside, outside).alias("ratio")
    )


def frequencies(df: DataFrame, col: str) -> DataFrame:
    """Count and percentage per non-null value, most frequent first."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(rows().alias("n"))
    everything = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / everything).orderBy(F.desc("n"), col)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max per column."""
    long = melt(df, cols)
    basic = long.groupBy("feature").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    return basic.join(quantiles(long, "value", QUARTILES, ["feature"]), "feature")


def corrected_skew(skew: Column, n: Column) -> Column:
    """Sample skewness from the population one; null below three rows."""
    return F.when(n > 2, skew * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(kurt: Column, n: Column) -> Column:
    """Sample excess kurtosis from the population one; null below four rows."""
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * kurt + 6))


def scalar_summary(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    n = F.count(col)
    return df.groupBy(*keys).agg(
        F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"), F.min(col).alias("min"),
        F.max(col).alias("max"), (F.max(col) - F.min(col)).alias("range"),
        corrected_skew(F.skewness(col), n).alias("skew"),
    )


def moments(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis."""
    n = F.count(col)
    return df.groupBy(*keys).agg(
        corrected_skew(F.skewness(col), n).alias("skew"),
        corrected_kurtosis(F.kurtosis(col), n).alias("kurtosis"),
    )


def grouped(df: DataFrame, keys: Sequence[str | Column], **aggs: Column) -> DataFrame:
    """Named aggregates per group; keys may be expressions."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def group_rate(df: DataFrame, keys: Sequence[str], condition: Column, name: str = "rate") -> DataFrame:
    return df.groupBy(*keys).agg(rows().alias("n"), F.avg(condition.cast("double")).alias(name))


def recurring(df: DataFrame, amount: str, keys: Sequence[str], steps: Sequence[int] = (10, 50),
              minimum: int = 3) -> DataFrame:
    """Groups of like amounts: recurring when they have at least `minimum` rows.

    Amounts are rounded to the finest of `steps` that finds any recurring group;
    where none does, the coarsest one is reported.
    """
    per_step = None
    for level, step in enumerate(steps):
        like = (F.bround(F.col(amount) / float(step), 0) * float(step)).alias("_like")
        one = (
            df.groupBy(like, *keys).agg(rows().alias("n"))
            .agg(
                F.count_if(F.col("n") >= minimum).alias("recurring_groups"),
                F.coalesce(F.sum(F.when(F.col("n") >= minimum, F.col("n"))), F.lit(0)).alias("recurring_rows"),
                F.sum("n").alias("rows"),
            )
            .select(F.lit(level).alias("level"), F.lit(step).cast("bigint").alias("step"), "*")
        )
        per_step = one if per_step is None else per_step.unionByName(one)
    hit = F.col("recurring_rows") > 0
    best = F.struct(F.when(hit, F.lit(0)).otherwise(F.lit(1)), F.when(hit, F.col("level")).otherwise(-F.col("level")))
    names = ["step", "recurring_groups", "recurring_rows", "rows"]
    return per_step.agg(F.min_by(F.struct(*names), best).alias("r")).select(
        "r.*", (F.col("r.rows") - F.col("r.recurring_rows")).alias("onetime_rows")
    )


def crosstab(df: DataFrame, a: str, b: str, value: Column | None = None) -> DataFrame:
    """Long contingency table of counts, or of a summed value."""
    cell = rows() if value is None else F.sum(value)
    return (
        df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(a, b)
        .agg(cell.alias("n" if value is None else "total"))
    )


def row_share(table: DataFrame, row: str, cell: str = "n") -> DataFrame:
    """Each cell of a long table as a share of its row."""
    return table.withColumn("share", F.try_divide(F.col(cell), F.sum(cell).over(W.partitionBy(row))))


def pivot(df: DataFrame, rows_by: Sequence[str], cols_by: str, labels: Sequence, value: Column) -> DataFrame:
    """Wide table; the column labels are given, so no extra pass looks for them."""
    return df.groupBy(*rows_by).pivot(cols_by, list(labels)).agg(value)


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return wide.unpivot([], list(cols), "feature", "n_distinct")
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "feature", "value")
    return long.distinct().groupBy("feature").agg(F.count("value").alias("n_distinct"))


def class_mean_gap(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Means of each class per feature, largest absolute difference first."""
    long = melt(df, features, [label])
    return (
        long.groupBy("feature")
        .agg(
            F.avg(F.when(F.col(label) == 1, F.col("value"))).alias("mean_1"),
            F.avg(F.when(F.col(label) == 0, F.col("value"))).alias("mean_0"),
        )
        .withColumn("gap", F.abs(F.col("mean_1") - F.col("mean_0")))
        .orderBy(F.desc("gap"), "feature")
    )


def corr_matrix(df: DataFrame, cols: Sequence[str], lower: bool = False) -> DataFrame:
    """Long Pearson matrix of any width; every pair uses the rows with both values.

    Tasks add up counts, sums and products per pair as matrix products of the values
    (less their means, for accuracy) and of their masks; one small row per pair and
    task is shuffled.  NaN where a value does not vary, null for fewer than two rows.
    """
    names = list(cols)
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    means = [m or 0.0 for m in numbers.agg(*[F.avg(c) for c in numbers.columns]).first()]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = len(names)
        total = np.zeros((len(_MOMENTS), p, p))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - means
            here = ~np.isnan(x)
            mask = here.astype(float)
            x[~here] = 0.0
            squares = x * x
            total += [mask.T @ mask, x.T @ mask, mask.T @ x, squares.T @ mask, mask.T @ squares, x.T @ x]
        i, j = np.nonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *[pa.array(m[i, j]) for m in total]], ["i", "j", *_MOMENTS])

    schema = "i long, j long, " + ", ".join(f"{m} double" for m in _MOMENTS)
    pairs = numbers.mapInArrow(sums, schema).groupBy("i", "j").agg(*[F.sum(m).alias(m) for m in _MOMENTS])
    wanted = df.sparkSession.range(len(names) ** 2).select(
        F.floor(F.col("id") / len(names)).alias("i"), F.pmod("id", F.lit(len(names))).alias("j"))
    pairs = wanted.filter("i > j" if lower else "true").join(pairs, ["i", "j"], "left")
    spread = lambda square, plain: F.greatest(F.col(square) - F.col(plain) * F.col(plain) / F.col("n"), F.lit(0.0))
    scale = F.sqrt(spread("xx", "x") * spread("yy", "y"))
    r = (F.col("xy") - F.col("x") * F.col("y") / F.col("n")) / F.when(scale > 0, scale)
    name = lambda c: F.element_at(F.array(*[F.lit(n) for n in names]), (F.col(c) + 1).cast("int"))
    return pairs.select(
        name("i").alias("feature_a"), name("j").alias("feature_b"),
        F.when(F.col("n") > 1, F.coalesce(F.when(F.col("i") == F.col("j"), F.when(scale > 0, 1.0)).otherwise(r), F.lit(float("nan")))).alias("r"))


def corr_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in features])
    return wide.unpivot([], list(features), "feature", "r").orderBy(F.desc(F.abs("r")), "feature")


def argmax(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Keys of the largest and smallest aggregate; the smaller key wins a tie."""
    groups = df.groupBy(key).agg(value.alias("v"))
    return groups.agg(
        F.min_by(key, F.struct(-F.col("v"), key)).alias("top"), F.max("v").alias("top_value"),
        F.min_by(key, F.struct("v", key)).alias("bottom"), F.min("v").alias("bottom_value"),
    )


def top_variance(df: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    wide = df.agg(*[F.var_samp(c).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "feature", "variance").orderBy(F.desc("variance"), "feature").limit(k)


def iqr_bounds(df: DataFrame, value: str, keys: Sequence[str] = (), width: float = 1.5) -> DataFrame:
    """Quartiles, fences, and the rows outside them.

    Outliers are counted on distinct values, which the quartiles need anyway.
    """
    q = quantiles(df, value, {"q1": 0.25, "q3": 0.75}, keys)
    span = F.col("q3") - F.col("q1")
    fences = q.withColumns({"lower": F.col("q1") - width * span, "upper": F.col("q3") + width * span})
    counts = value_counts(df, value, keys)
    if keys:
        joined = counts.join(fences, list(keys))
    else:
        joined = counts.withColumn("_f", fences.select(F.struct("*")).scalar()).select("*", "_f.*")
    outside = (F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper"))
    return joined.groupBy(*keys, "q1", "q3", "lower", "upper").agg(
        F.sum("n").alias("n"), F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outliers")
    ).withColumn("outlier_pct", F.col("outliers") * 100.0 / F.col("n"))


def shares(df: DataFrame, key: str, value: str) -> DataFrame:
    """Total per group and its percentage of all."""
    totals = df.groupBy(key).agg(F.sum(value).alias("total"))
    everything = totals.agg(F.sum("total")).scalar()
    return totals.withColumn("pct", F.col("total") * 100.0 / everything)


def top_share(df: DataFrame, key: str, value: str, k: int = 2) -> DataFrame:
    """Percentage held by the k largest groups together."""
    ranked = shares(df, key, value).orderBy(F.desc("total"), key).limit(k)
    return ranked.agg(F.sum("pct").alias("top_pct"))


def hit_rates(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of positive and negative values, and values beyond one sample std."""
    stats = df.groupBy(*keys).agg(
        F.count_if(F.col(value) > 0).alias("positive"), F.count_if(F.col(value) < 0).alias("negative"),
        F.avg((F.col(value) > 0).cast("double")).alias("positive_rate"),
        F.stddev_samp(value).alias("std"),
    )
    if not keys:
        sd = stats.select("std").scalar()
        return df.withColumn("_sd", sd).agg(
            F.count_if(F.abs(value) > F.col("_sd")).alias("volatile"),
            F.count_if(F.col(value) > 0).alias("positive"),
            F.count_if(F.col(value) < 0).alias("negative"),
            F.avg((F.col(value) > 0).cast("double")).alias("positive_rate"),
        )
    beyond = df.join(stats.select(*keys, "std"), list(keys)).groupBy(*keys).agg(
        F.count_if(F.abs(value) > F.col("std")).alias("volatile")
    )
    return stats.drop("std").join(beyond, list(keys))


def flag_prevalence(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Percentage of rows with each 0/1 flag set."""
    wide = df.agg(*[(F.avg(c.cast("double")) * 100).alias(n) for n, c in flags.items()])
    return wide.unpivot([], list(flags), "flag", "pct")


def flagged_breakdown(df: DataFrame, flag: Column, keys: Sequence[str | Column], value: str) -> DataFrame:
    return df.filter(flag).groupBy(*keys).agg(
        rows().alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"), F.max(value).alias("max")
    )
