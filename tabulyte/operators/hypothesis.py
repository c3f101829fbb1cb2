"""Hypothesis tests from grouped sufficient statistics.

Rows are aggregated first; the statistic is then an expression over a few rows.
Rank tests work on distinct values with their counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.functions import dist
from tabulyte.operators.aggregates import crosstab
from tabulyte.operators.joins import group_pairs
from tabulyte.operators.ordering import melt, running
from tabulyte.session import written

ALL = W.partitionBy


def chi2_table(table: DataFrame, row: str, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Independence test of a long count table `(row, col, n)`; with one degree
    of freedom the deviation is reduced by up to one half per cell.

    Cells without a row count as 0: they add nothing to the sum of n²/(r·c).
    """
    def margin(*by: str, name: str) -> DataFrame:
        return table.groupBy(*keys, *by).agg(F.sum("n").cast("double").alias(name)).withColumnsRenamed({k: f"_k_{name}_{k}" for k in (*keys, *by)})

    # marginals joined back: no window over a key, nor over all cells where there is none
    m = table
    for by, name in (((row,), "_r"), ((col,), "_c"), ((), "_t")):
        same = [F.col(k).eqNullSafe(F.col(f"_k_{name}_{k}")) for k in (*keys, *by)]
        m = m.join(margin(*by, name=name), same) if same else m.crossJoin(F.broadcast(margin(*by, name=name)))  # one row
    n, r, c, t = (F.col(x) for x in ("n", "_r", "_c", "_t"))
    s = m.groupBy(*keys).agg(
        F.max(t).alias("_n"), F.count_distinct(row).alias("_rows"), F.count_distinct(col).alias("_cols"),
        F.sum(n * n / (r * c)).alias("_q"), F.max(F.abs(n - r * c / t)).alias("_d"),
        F.max(F.try_divide(t * t * t, r * (t - r) * c * (t - c))).alias("_w"),
    )
    df = (F.col("_rows") - 1) * (F.col("_cols") - 1)
    plain = F.col("_n") * (F.col("_q") - 1)
    reduced = F.pow(F.col("_d") - F.least(F.lit(0.5), F.col("_d")), 2) * F.col("_w")
    out = s.select(
        *keys, F.when(df == 1, reduced).otherwise(F.greatest(plain, F.lit(0.0))).alias("chi2"),
        df.alias("df"), F.col("_n").cast("bigint").alias("n"),
        F.least(F.col("_rows"), F.col("_cols")).alias("_k"),
    )
    return out.withColumn("p_value", dist.chi2_p("chi2", "df")).withColumn(
        "cramers_v", F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * (F.col("_k") - 1)))
    ).drop("_k")


def chi2(df: DataFrame, row: str, col: str) -> DataFrame:
    return chi2_table(crosstab(df, row, col), row, col)


def relative_risk(df: DataFrame, group: Column, event: Column) -> DataFrame:
    """Event rates inside and outside a group, and their ratio."""
    hit = event.cast("double")
    inside, outside = F.avg(F.when(group, hit)), F.avg(F.when(~group, hit))
    return df.agg(
        inside.alias("rate_in"), outside.alias("rate_out"), F.try_divide(inside, outside).alias("risk_ratio")
    )


def two_groups(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Per feature: size, mean and sample variance of label 1 and label 0."""
    long = melt(df, features, [label])
    side = lambda k, c="value": F.when(F.col(label) == k, F.col(c))
    return long.groupBy("feature").agg(
        *[
            f(side(k)).alias(f"{n}{k}")
            for k in (1, 0)
            for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))
        ]
    )


def t_pooled(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Student's t with equal variances, per feature."""
    s = two_groups(df, features, label)
    dof = F.col("n1") + F.col("n0") - 2
    pooled = ((F.col("n1") - 1) * F.col("v1") + (F.col("n0") - 1) * F.col("v0")) / dof
    t = F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n0"))))
    return s.select("feature", F.col("m1").alias("mean_1"), F.col("m0").alias("mean_0"), t.alias("t"),
                    dof.alias("df")).withColumn("p_value", dist.t_p("t", "df"))


def t_welch(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Welch's t per feature, smallest p first."""
    s = two_groups(df, features, label)
    a, b = F.col("v1") / F.col("n1"), F.col("v0") / F.col("n0")
    t = F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(a + b))
    dof = F.try_divide(F.pow(a + b, 2), a * a / (F.col("n1") - 1) + b * b / (F.col("n0") - 1))
    out = s.select("feature", F.col("m1").alias("mean_1"), F.col("m0").alias("mean_0"), t.alias("t"), dof.alias("df"))
    return out.withColumn("p_value", dist.t_p("t", "df")).orderBy("p_value", "feature")


def cohen_d(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Effect size with the pooled, the averaged, and the population deviation."""
    s = two_groups(df, features, label)
    gap = F.col("m1") - F.col("m0")
    n1, n0, v1, v0 = (F.col(c) for c in ("n1", "n0", "v1", "v0"))
    return s.select(
        "feature",
        F.try_divide(gap, F.sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2))).alias("pooled"),
        F.try_divide(gap, F.sqrt((v1 + v0) / 2)).alias("averaged"),
        F.try_divide(gap, F.sqrt((v1 * (n1 - 1) / n1 + v0 * (n0 - 1) / n0) / 2)).alias("population"),
    )


def anova(df: DataFrame, features: Sequence[str], group: str) -> DataFrame:
    """One-way F per feature."""
    cells = melt(df, features, [group]).groupBy("feature", group).agg(
        F.count("value").alias("n"), F.avg("value").alias("m"), F.var_samp("value").alias("v")
    ).filter("n > 0")
    grand = cells.withColumn("_g", F.sum(F.col("n") * F.col("m")).over(W.partitionBy("feature"))
                             / F.sum("n").over(W.partitionBy("feature")))
    s = grand.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_k"), F.sum("n").alias("_n"),
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("_g"), 2)).alias("_between"),
        F.sum((F.col("n") - 1) * F.coalesce(F.col("v"), F.lit(0.0))).alias("_within"),
    )
    d1, d2 = F.col("_k") - 1, F.col("_n") - F.col("_k")
    return s.select(
        "feature", F.try_divide(F.col("_between") / d1, F.col("_within") / d2).alias("f"),
        d1.alias("df1"), d2.alias("df2"),
    ).withColumn("p_value", dist.f_p("f", "df1", "df2"))


def _class_counts(df: DataFrame, value: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct values with the rows of label 1 and all rows, and running sums of both."""
    counts = (
        df.filter(F.col(value).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, value)
        .agg(F.sum((F.col(label) == 1).cast("bigint")).alias("n1"), F.count(F.lit(1)).alias("n"))
    )
    return running(counts, [value], {"cum": ("sum", "n"), "cum1": ("sum", "n1")}, keys, totals=True)


def mann_whitney_counts(counts: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """The test from distinct values with `n1` of `n` rows in the first sample."""
    ranked = running(counts, [value], {"cum": ("sum", "n")}, keys)
    rank = F.col("cum") - (F.col("n") - 1) / 2.0
    ties = F.col("n").cast("double")
    s = ranked.groupBy(*keys).agg(
        F.sum("n1").cast("double").alias("_n1"), F.sum("n").cast("double").alias("_n"),
        F.sum(F.col("n1") * rank).alias("_r1"), F.sum(F.pow(ties, 3) - ties).alias("_ties"),
    )
    n1, n = F.col("_n1"), F.col("_n")
    n2 = n - n1
    u1 = F.col("_r1") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n2 / 12 * (n + 1 - F.col("_ties") / (n * (n - 1))))
    z = F.try_divide(F.greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5, sd)
    return s.select(*keys, u1.alias("u"), z.alias("z")).withColumn("p_value", dist.normal_p(F.greatest("z", F.lit(0.0))))


def mann_whitney(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Two-sided U per feature with tie and continuity correction."""
    long = melt(df, features, [label]).filter(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("n1"), F.count(F.lit(1)).alias("n")
    )
    return mann_whitney_counts(counts, "value", ["feature"]).orderBy("p_value", "feature")


def kruskal(df: DataFrame, value: str, group: str) -> DataFrame:
    """H over any number of groups, tie-corrected: the ranks of the distinct values are
    joined back to the counts of each value and group."""
    cells = df.filter(F.col(value).isNotNull()).groupBy(value, group).agg(F.count(F.lit(1)).alias("k"))
    cells = written(cells, "cells")
    ranked = running(cells.groupBy(value).agg(F.sum("k").alias("n")), [value], {"cum": ("sum", "n")})
    ranked = ranked.withColumn("_rank", F.col("cum") - (F.col("n") - 1) / 2.0)
    size = F.col("n").cast("double")
    ties = ranked.agg(F.struct(F.sum(size).alias("n"), F.sum(F.pow(size, 3) - size).alias("t"))).scalar()
    groups = (
        cells.join(ranked.select(value, "_rank"), value)
        .groupBy(group)
        .agg(F.sum("k").cast("double").alias("k"), F.sum(F.col("k") * F.col("_rank")).alias("r"))
    )
    s = groups.agg(F.sum(F.col("r") * F.col("r") / F.col("k")).alias("_s"), F.count(F.lit(1)).alias("_k"))
    s = s.withColumn("_t", ties)
    n = F.col("_t.n")
    h = (12 / (n * (n + 1)) * F.col("_s") - 3 * (n + 1)) / (1 - F.col("_t.t") / (n * n * n - n))
    return s.select(h.alias("h"), (F.col("_k") - 1).alias("df")).withColumn("p_value", dist.chi2_p("h", "df"))


def ks_two_sample(df: DataFrame, value: str, label: str) -> DataFrame:
    """Largest distance between the two empirical distributions."""
    c = _class_counts(df, value, label)
    n1, n0 = F.col("cum1_total"), F.col("cum_total") - F.col("cum1_total")
    gap = F.abs(F.col("cum1") / n1 - (F.col("cum") - F.col("cum1")) / n0)
    s = c.agg(F.max(gap).alias("ks"), F.max(n1).alias("n1"), F.max(n0).alias("n0"))
    scaled = F.col("ks") * F.sqrt(F.col("n1") * F.col("n0").cast("double") / (F.col("n1") + F.col("n0")))
    return s.withColumn("p_value", dist.kolmogorov_p(scaled))


def normal_test(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """D'Agostino's K² from population skewness and kurtosis."""
    s = melt(df, features).groupBy("feature").agg(
        F.count("value").cast("double").alias("n"), F.skewness("value").alias("g1"),
        (F.kurtosis("value") + 3).alias("b2"),
    )
    n = F.col("n")
    y = F.col("g1") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    u = y / F.sqrt(2 / (w2 - 1))
    z1 = F.ln(u + F.sqrt(u * u + 1)) / F.sqrt(0.5 * F.ln(w2))
    mean = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("b2") - mean) / F.sqrt(var)
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    base = (1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4)))
    cube = F.signum(base) * F.pow(F.abs(base), F.lit(1 / 3))
    z2 = (1 - 2 / (9 * a) - cube) / F.sqrt(2 / (9 * a))
    k2 = z1 * z1 + z2 * z2
    return s.select("feature", k2.alias("k2"), F.exp(-k2 / 2).alias("p_value"))


def jarque_bera(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    jb = F.count(value) / 6 * (F.pow(F.skewness(value), 2) + F.pow(F.kurtosis(value), 2) / 4)
    return df.groupBy(*keys).agg(jb.alias("jb")).withColumn("p_value", F.exp(-F.col("jb") / 2))


def variance_ratio(df: DataFrame, value: str, late: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Sample variances before and after a split, and the larger over the smaller."""
    s = df.groupBy(*keys).agg(
        F.var_samp(F.when(~late, F.col(value))).alias("var_before"),
        F.var_samp(F.when(late, F.col(value))).alias("var_after"),
    )
    return s.withColumn("f", F.try_divide(F.greatest("var_before", "var_after"), F.least("var_before", "var_after")))


def benford(df: DataFrame, value: str) -> DataFrame:
    """First significant digits against Benford's law, with the chi-square."""
    digit = F.regexp_extract(F.abs(value).cast("string"), "[1-9]", 0)
    counts = df.filter(digit != "").groupBy(digit.cast("bigint").alias("digit")).agg(F.count(F.lit(1)).alias("n"))
    digits = df.sparkSession.range(1, 10).withColumnRenamed("id", "digit")
    full = digits.join(counts, "digit", "left").na.fill(0, ["n"])
    expected = F.log10(1 + 1 / F.col("digit")) * F.sum("n").over(ALL())
    s = full.withColumn("expected", expected)
    chi = F.sum(F.pow(F.col("n") - F.col("expected"), 2) / F.col("expected")).over(ALL())
    return s.withColumn("chi2", chi).withColumn("p_value", dist.chi2_p("chi2", F.lit(8.0)))


def regime_chi2(df: DataFrame, value: str, late: Column) -> DataFrame:
    """Whether values beyond one standard deviation are as common after a split."""
    sd = df.agg(F.stddev_samp(value)).scalar()
    flagged = df.filter(F.col(value).isNotNull()).withColumn("_sd", sd).select(
        late.cast("int").alias("late"), (F.abs(value) > F.col("_sd")).cast("int").alias("volatile")
    )
    return chi2(flagged, "late", "volatile")


def pairwise_t(df: DataFrame, value: str, group: str) -> DataFrame:
    """Pooled t and effect size of every pair of groups."""
    stats = df.groupBy(F.col(group).alias("k")).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v")
    )
    p = group_pairs(stats, "k")
    na, nb = F.col("n_a"), F.col("n_b")
    pooled = ((na - 1) * F.col("v_a") + (nb - 1) * F.col("v_b")) / (na + nb - 2)
    gap = F.col("m_a") - F.col("m_b")
    return p.select(
        "k_a", "k_b", F.try_divide(gap, F.sqrt(pooled * (1 / na + 1 / nb))).alias("t"),
        F.try_divide(gap, F.sqrt((F.col("v_a") + F.col("v_b")) / 2)).alias("d"), (na + nb - 2).alias("df"),
    ).withColumn("p_value", dist.t_p("t", "df"))


def normal_interval(df: DataFrame, value: str, keys: Sequence[str] = (), z: float = 1.96) -> DataFrame:
    half = z * F.stddev_samp(value) / F.sqrt(F.count(value))
    return df.groupBy(*keys).agg(
        F.avg(value).alias("mean"), (F.avg(value) - half).alias("lower"), (F.avg(value) + half).alias("upper")
    )
