"""Known results of small literal inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulyte.functions import dist, maths
from tabulyte.operators import bayes, hypothesis as hy, metrics as me
from tabulyte.operators.clean import cut


def table(spark, cells):
    rows = [(f"r{i}", f"c{j}", n) for i, row in enumerate(cells) for j, n in enumerate(row)]
    return spark.createDataFrame(rows, "a string, b string, n bigint")


@pytest.mark.parametrize(
    "cells, chi2, p",
    [
        ([[944, 110], [289, 127]], 87.5643, None),
        ([[501, 87], [732, 150]], 1.1170, 0.290572),
        ([[51, 12], [828, 133], [354, 92]], 10.7960, 0.004526),
        ([[138, 12], [208, 69], [887, 156]], 24.1824, 0.000006),
        ([[97008, 94202], [2992, 5798]], 936.26, None),
        ([[64237, 48589], [35763, 51411]], 4978.47, None),
    ],
)
def test_chi2(spark, cells, chi2, p):
    row = hy.chi2_table(table(spark, cells), "a", "b").first()
    assert row.chi2 == pytest.approx(chi2, abs=0.006)
    if p is not None:
        assert row.p_value == pytest.approx(p, abs=6e-7)


def test_chi2_counts_an_absent_cell_as_zero(spark):
    full = hy.chi2_table(table(spark, [[30, 0, 5], [10, 20, 5]]), "a", "b").first()
    sparse = hy.chi2_table(table(spark, [[30, 0, 5], [10, 20, 5]]).filter("n > 0"), "a", "b").first()
    assert full.chi2 == pytest.approx(sparse.chi2)
    two = hy.chi2_table(table(spark, [[8, 0], [2, 5]]).filter("n > 0"), "a", "b").first()
    assert two.chi2 == pytest.approx(15 * (8 * 5 - 7.5) ** 2 / (8 * 7 * 10 * 5))


@pytest.mark.parametrize(
    "k, n, mean, lower, upper",
    [
        (127, 416, 0.3062, 0.2630, 0.3512), (110, 1054, 0.1051, 0.0873, 0.1243), (92, 446, None, 0.171, 0.246),
        (133, 961, None, 0.118, 0.162), (12, 63, None, 0.113, 0.305), (220, 6819, None, 0.0283, 0.0367),
        (2, 5019, None, 0.0001, 0.0014),
    ],
)
def test_beta_posterior(spark, k, n, mean, lower, upper):
    row = bayes.posterior_of_counts(spark.createDataFrame([(k, n)], "k bigint, n bigint")).first()
    digits = 6e-4 if mean is None else 6e-5
    assert row.lower == pytest.approx(lower, abs=digits) and row.upper == pytest.approx(upper, abs=digits)
    if mean:
        assert row["mean"] == pytest.approx(mean, abs=6e-5)


def test_posterior_draws(spark):
    rows = [(1, 1, 127), (1, 0, 289), (0, 1, 110), (0, 0, 944)]
    df = spark.createDataFrame(rows, "g int, e int, n int").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    draws = bayes.rate_draws(df, F.col("g") == 1, F.col("e") == 1).cache()
    assert bayes.prob_greater(draws).first()[0] == pytest.approx(1.0, abs=1e-3)
    risk = bayes.relative_risk(draws).first()
    assert (risk["mean"], risk.lower, risk.upper) == pytest.approx((2.936, 2.322, 3.670), abs=0.03)
    assert hy.relative_risk(df, F.col("g") == 1, F.col("e") == 1).first().risk_ratio == pytest.approx(2.93, abs=0.006)


@pytest.mark.parametrize(
    "tn, fp, fn, tp, expected",
    [
        (1173, 147, 8, 36, dict(precision=0.1967, recall=0.8182, f1=0.3172, accuracy=0.8864)),
        (1316, 4, 35, 9, dict(precision=0.6923, recall=0.2045, f1=0.3158, accuracy=0.9714)),
        (19374, 526, 27, 73, dict(precision=0.12, recall=0.73, f1=0.21)),
    ],
)
def test_binary_rates(spark, tn, fp, fn, tp, expected):
    row = me.binary_from_counts(spark.createDataFrame([(tp, fp, fn, tn)], "tp long, fp long, fn long, tn long")).first()
    for name, value in expected.items():
        assert row[name] == pytest.approx(value, abs=0.005 if value in (0.12, 0.73, 0.21) else 6e-5)


def test_cost_matrix_and_report(spark):
    counts = [[39, 25, 4], [23, 36, 9], [3, 13, 48]]
    costs = {("0", "0"): 0, ("0", "1"): 1, ("0", "2"): 5, ("1", "0"): 3, ("1", "1"): 0, ("1", "2"): 8,
             ("2", "0"): 10, ("2", "1"): 6, ("2", "2"): 0}
    rows = [(str(i), str(j)) for i in range(3) for j in range(3) for _ in range(counts[i][j])]
    df = spark.createDataFrame(rows, "y string, pred string")
    assert me.cost_matrix(df, costs).filter("actual = 'total'").first().cost == 294
    report = {r.name: r for r in me.class_report(df).collect()}
    assert report["accuracy"].f1 == pytest.approx(0.6150, abs=6e-5)
    assert report["macro avg"].f1 == pytest.approx(0.6205, abs=6e-5)


def test_normal_interval():
    half = 1.96 * 254.91 / np.sqrt(100000)
    assert (607.75 - half, 607.75 + half) == pytest.approx((606.17, 609.33), abs=0.006)


def test_tail_probabilities():
    assert dist.gamma_upper(1.0, 10.7960 / 2) == pytest.approx(np.exp(-10.7960 / 2))
    assert dist.beta_lower(0.5, 0.5, 0.5) == pytest.approx(0.5)
    assert dist.beta_lower(10 / 2, 0.5, 10 / (10 + 2.228139**2)) == pytest.approx(0.05, abs=1e-6)
    assert dist.beta_lower(10 / 2, 3 / 2, 10 / (10 + 3 * 3.708265)) == pytest.approx(0.05, abs=1e-6)
    assert 2 * dist.normal_upper(1.959964) == pytest.approx(0.05, abs=1e-7)
    assert dist.kolmogorov_tail(1.3581) == pytest.approx(0.05, abs=1e-4)
    for x in (0.3, 1.0, 7.5, 40.0):
        assert dist.digamma(x + 1) - dist.digamma(x) == pytest.approx(1 / x)
        assert dist.trigamma(x) - dist.trigamma(x + 1) == pytest.approx(1 / x**2)


def test_normal_quantile_expression(spark):
    ps = [1e-12, 1e-5, 0.01, 0.075, 0.3, 0.5, 0.8, 0.925, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(maths.normal_quantile("p")).collect()]
    assert got == pytest.approx([dist.normal_quantile(p) for p in ps], rel=1e-7, abs=1e-12)


def test_cut_excludes_the_lowest_edge(spark):
    df = spark.createDataFrame([(18,), (19,), (25,), (26,), (90,)], "x int")
    assert [r[0] for r in df.select(cut("x", [18, 25, 35], ["a", "b"])).collect()] == [None, "a", "a", "b", None]


def test_commons_math_agrees(spark):
    beta = spark.sparkContext._jvm.org.apache.commons.math3.distribution.BetaDistribution(128.0, 290.0)
    assert dist.beta_quantile(0.025, 128, 290) == pytest.approx(beta.inverseCumulativeProbability(0.025), abs=1e-6)
