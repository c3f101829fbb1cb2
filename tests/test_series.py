"""Window indicators and time-series fits against pandas and plain loops."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulyte.operators import series as se, smoothing, timeseries as ts


@pytest.fixture(scope="module")
def prices():
    rng = np.random.default_rng(11)
    days = pd.date_range("2020-01-01", periods=400).date
    return pd.concat([
        pd.DataFrame({"k": k, "d": days, "x": 1 + rng.normal(0, 0.01, 400).cumsum()}) for k in ("a", "b")
    ], ignore_index=True)


@pytest.fixture(scope="module")
def s(spark, prices):
    return se.Series(spark.createDataFrame(prices), ("k",), "d", "x")


def one(df, k="a"):
    return df.toPandas().query("k == @k").sort_values("d").reset_index(drop=True)


def test_rolling_ewm_and_interpolate(spark, prices, s):
    x = prices.query("k == 'a'")["x"].reset_index(drop=True)
    assert np.allclose(one(s.with_columns(m=se.rolling(s, 20)).df)["m"], x.rolling(20).mean(), equal_nan=True)
    assert np.allclose(one(se.ewm(s, {"e": 12}))["e"], x.ewm(span=12, adjust=False).mean())
    holes = prices.assign(x=prices["x"].where(np.arange(len(prices)) % 7 > 2))
    gap = se.Series(spark.createDataFrame(holes).withColumn("x", F.nanvl("x", F.lit(None))), ("k",), "d", "x")
    want = holes.query("k == 'a'")["x"].reset_index(drop=True).interpolate()
    assert np.allclose(one(se.interpolate(gap))["filled"].astype(float), want, equal_nan=True)


def test_cusum_equals_the_loop(prices, s):
    x = prices.query("k == 'b'")["x"].to_numpy()
    m, sd = x.mean(), x.std(ddof=1)
    pos, neg = np.zeros(len(x)), np.zeros(len(x))
    for i in range(1, len(x)):
        pos[i] = max(0, pos[i - 1] + x[i] - m - sd / 2)
        neg[i] = max(0, neg[i - 1] + m - x[i] - sd / 2)
    got = one(se.cusum(s), "b")
    assert np.allclose(got["cusum_pos"], pos) and np.allclose(got["cusum_neg"], neg)
    assert (got["breach"] == (np.abs(pos - neg) > 4 * sd)).all()


def test_change_point_is_found(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, 200), rng.normal(3, 1, 150)])
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "d": np.arange(350), "x": x}))
    found = se.change_points(se.Series(df, ("k",), "d", "x")).toPandas()
    assert abs(found.iloc[0]["split"] - 200) <= 3
    gaps = np.diff(np.sort(found["split"]))
    assert len(found) <= 8 and (gaps >= 50).all()


def test_backtest_equals_the_loop(prices, s):
    x = prices.query("k == 'a'").set_index("d")["x"]
    bt = pd.DataFrame({"p": x, "f": x.rolling(50).mean(), "s": x.rolling(200).mean()}).dropna()
    sig = np.where(bt["f"] > bt["s"], 1.0, -1.0)
    equity = [10_000.0]
    for i in range(1, len(bt)):
        ret = bt["p"].iloc[i] / bt["p"].iloc[i - 1] - 1
        equity.append(equity[-1] * (1 + sig[i - 1] * ret - abs(sig[i] - sig[i - 1]) / 2 * 0.0005))
    assert np.allclose(one(se.backtest(s))["equity"], equity)


def _least_squares(x: np.ndarray, y: np.ndarray):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    return beta, float(resid @ resid)


def plain_unit_root(x: np.ndarray, constant: bool = True) -> tuple[float, int, int]:
    """Augmented Dickey-Fuller statistic, the lags chosen by AIC, and the rows used."""
    n = len(x)
    most = max(0, min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2))
    d = np.diff(x)

    def design(lags: int, skip: int):
        y = d[skip:]
        cols = [x[skip:-1]] + [d[skip - k:len(d) - k] for k in range(1, lags + 1)]
        if constant:
            cols.append(np.ones(len(y)))
        return np.column_stack(cols), y

    def aic(lags: int) -> float:
        a, y = design(lags, most)
        _, sse = _least_squares(a, y)
        m = len(y)
        return m * (math.log(2 * math.pi * sse / m) + 1) + 2 * a.shape[1]

    best = min(range(most + 1), key=aic)
    a, y = design(best, best)
    beta, sse = _least_squares(a, y)
    se = math.sqrt(sse / (len(y) - a.shape[1]) * np.linalg.inv(a.T @ a)[0, 0])
    return float(beta[0] / se), best, len(y)


@pytest.mark.parametrize("block", [64, 65_536])
def test_unit_roots_and_autoregressions_equal_plain_loops(spark, block):
    """Series that span many blocks, short ones, a constant one, gaps and a null key."""
    rng = np.random.default_rng(6)
    values = {"walk": rng.normal(0, 1, 700).cumsum() + 50, "ar": rng.normal(0, 1, 300), None: rng.normal(0, 1, 90).cumsum(), "short": np.arange(4.0) ** 2, "one": np.ones(1), "flat": np.ones(50)}
    rows = [(k, i, float(v)) for k, x in values.items() for i, v in enumerate(x)] + [("walk", 10_000, None), ("none", 1, None)]
    s = se.Series(spark.createDataFrame(rows, "k string, d int, x double").repartition(5), ("k",), "d", "x")
    got = {r.k: r for r in ts.adf(s, block).collect()}
    assert set(got) == set(values)
    for k in ("walk", "ar", None):
        stat, lags, n = plain_unit_root(values[k])
        assert (got[k].lags, got[k].n) == (lags, n) and got[k].stat == pytest.approx(stat, rel=1e-8)
        assert got[k].p_value == pytest.approx(ts.unit_root_p(stat), rel=1e-6)
    assert got["one"].stat is None and got["flat"].stat is None and got["flat"].stationary is None
    ahead = ts.arima(s, 5, 7, block).toPandas()
    for k in ("walk", "ar"):
        x = values[k]
        d = np.diff(x)
        beta, sse = _least_squares(np.column_stack([d[5 - j:len(d) - j] for j in range(1, 6)]), d[5:])
        past, level, out = list(d), x[-1], []
        for _ in range(7):
            past.append(float(beta @ past[:-6:-1]))
            level += past[-1]
            out.append(level)
        mine = ahead[ahead["k"] == k].sort_values("step")
        assert np.allclose(mine["forecast"], out, rtol=1e-9) and np.allclose(mine["sigma"], math.sqrt(sse / (len(d) - 5)))
    assert ahead[ahead["k"] == "short"]["forecast"].isna().all() and len(ahead[ahead["k"] == "short"]) == 7


def test_unit_root_verdicts(spark):
    rng = np.random.default_rng(2)
    walk, noise = rng.normal(0, 1, 500).cumsum(), rng.normal(0, 1, 500)
    assert ts.unit_root_p(plain_unit_root(walk)[0]) > 0.05
    assert ts.unit_root_p(plain_unit_root(noise)[0]) < 0.01
    assert ts.unit_root_p(-2.86) == pytest.approx(0.05, abs=0.001)
    assert ts.unit_root_p(-3.34, 2) == pytest.approx(0.05, abs=0.001)
    both = pd.DataFrame({"k": "p", "d": np.arange(500), "a": 2 * walk + noise, "b": walk})
    row = ts.cointegration(spark.createDataFrame(both), ("k",), "d", "a", "b").first()
    assert row.p_value < 0.01 and row.slope == pytest.approx(2, abs=0.1)


def test_forecasts(spark):
    t = np.arange(140)
    x = 10 + 0.5 * t + 3 * np.sin(2 * np.pi * t / 7)
    values, rmse = smoothing.smooth_forecast(x, 7, 14)
    ahead = np.arange(140, 154)
    assert np.abs(values - (10 + 0.5 * ahead + 3 * np.sin(2 * np.pi * ahead / 7))).max() < 1.5
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "d": pd.date_range("2021-01-01", periods=140).date, "x": x}))
    out = ts.arima(se.Series(df, ("k",), "d", "x"), 5, 10).toPandas()
    assert np.allclose(out["forecast"], 10 + 0.5 * ahead[:10] + 3 * np.sin(2 * np.pi * ahead[:10] / 7), atol=1e-6)


def test_garch_recovers_persistence(spark):
    rng = np.random.default_rng(1)
    r, var = [], 1.0
    for _ in range(3000):
        r.append(np.sqrt(var) * rng.normal())
        var = 0.05 + 0.1 * r[-1] ** 2 + 0.85 * var
    price = 100 * np.cumprod(1 + np.array(r) / 100)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "d": np.arange(3000), "x": price}))
    row = ts.garch(se.Series(df, ("k",), "d", "x")).first()
    assert row.fitted and row.persistence == pytest.approx(0.95, abs=0.04)


def test_pacf_of_an_autoregression(spark):
    rng = np.random.default_rng(4)
    x = [0.0]
    for _ in range(3000):
        x.append(0.6 * x[-1] + rng.normal())
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "d": np.arange(3001), "x": x}))
    out = ts.pacf(se.Series(df, ("k",), "d", "x"), 10).toPandas().sort_values("lag")["pacf"].to_numpy()
    assert out[1] == pytest.approx(0.6, abs=0.05) and np.abs(out[2:]).max() < 0.08


def test_smoothing_over_blocks_equals_one_pass(spark):
    """Series of many blocks, the ends of blocks inside a period, and a short series."""
    rng = np.random.default_rng(9)
    t = np.arange(500)
    values = {"a": 10 + 0.1 * t + 3 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 1, 500), None: 5 + rng.normal(0, 1, 230).cumsum(), "c": np.array([1.0, 2.0, 4.0]), "d": np.array([5.0])}
    rows = [(k, i, float(v)) for k, x in values.items() for i, v in enumerate(x)] + [("a", 9999, None)]
    s = se.Series(spark.createDataFrame(rows, "k string, d int, x double").repartition(5), ("k",), "d", "x")
    one, many = (ts.holt_winters(s, 7, 10, block).toPandas() for block in (65_536, 64))
    for k, x in values.items():
        pick = lambda f: (f[f["k"].isna()] if k is None else f[f["k"] == k]).sort_values("step")
        want, rmse = smoothing.smooth_forecast(x, 7, 10)
        for got in (one, many):
            assert np.allclose(pick(got)["forecast"], want, rtol=1e-6) and np.allclose(pick(got)["rmse"], rmse, rtol=1e-8)


def test_smoothing_maps_compose():
    rng = np.random.default_rng(3)
    weights, x = rng.uniform(0.05, 0.95, (20, 3)), rng.normal(size=40)
    state = rng.normal(size=(20, 9))
    _, end = smoothing.run(x, state, weights)
    _, zero = smoothing.run(x, np.zeros((20, 9)), weights)
    assert np.allclose(end, smoothing.after(weights, state, 40) + zero)


def test_refined_weights_beat_a_coarse_grid():
    rng = np.random.default_rng(4)
    t = np.arange(300)
    x = 20 + 0.05 * t + 4 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 1, 300)
    start, steps = smoothing.first_state(x, 7), np.linspace(0.05, 0.95, 9)
    grid = np.stack([v.ravel() for v in np.meshgrid(steps, steps, steps)], axis=1)
    coarse = smoothing.run(x, np.tile(start, (len(grid), 1)), grid)[0].min()
    assert smoothing.smooth_forecast(x, 7, 1)[1] <= np.sqrt(coarse / 300) * 1.0001
