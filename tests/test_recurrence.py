"""Scans of recurrences against the plain recursion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulyte.operators.recurrence import exponential_means, scan


def plain(x, q):
    out, y = [], 0.0
    for v in x:
        y = q * y + v
        out.append(y)
    return np.array(out)


@pytest.mark.parametrize("q", [0.999999, 0.9, 0.2, 1e-3, 1e-100, 1e-200])
def test_scan_equals_recursion(spark, q):
    rng = np.random.default_rng(3)
    series = {"a": rng.normal(size=3000), "b": rng.normal(size=256) * 1e6, None: rng.normal(size=1)}
    rows = [(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)]
    out = scan(spark.createDataFrame(rows, "k string, _i long, x double").repartition(7), ["k"], {"x": q}).toPandas()
    for k, x in series.items():
        got = out[out["k"].isna() if k is None else out["k"] == k].sort_values("_i")["x"].to_numpy()
        assert np.allclose(got, plain(x, q), rtol=1e-10, atol=1e-10 * np.abs(x).max())


def test_one_long_series(spark):
    """A series of a million rows: three levels of blocks, and as many tasks as partitions."""
    n = 1_000_000
    df = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.sin(F.col("id") / 50) + F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("x"))
    means = exponential_means(df, ["k"], "t", {"fast": ("x", 2 / 13), "slow": ("x", 2 / 2001)})
    got = means.toPandas().sort_values("t")
    for name, span in (("fast", 12), ("slow", 2000)):
        assert np.allclose(got[name], got["x"].ewm(span=span, adjust=False).mean(), rtol=1e-9)
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "InArrow" not in plan


def test_gaps_repeats_and_empty_tables(spark):
    schema = "k string, t int, x double, fast double"
    rows = [("a", 1, None, 9.0), ("a", 2, 1.0, 9.0), ("a", 3, None, 9.0), ("a", 4, 3.0, 9.0), (None, 1, 5.0, 9.0)]
    df = spark.createDataFrame(rows, schema).drop("fast")
    got = {(r.k, r.t): r.m for r in exponential_means(df, ["k"], "t", {"m": ("x", 0.5)}).collect()}
    assert got == {("a", 1): None, ("a", 2): 1.0, ("a", 3): None, ("a", 4): 2.0, (None, 1): 5.0}
    assert exponential_means(df.limit(0), ["k"], "t", {"m": ("x", 0.5)}).count() == 0
