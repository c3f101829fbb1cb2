"""Calendars, decomposition, autocorrelation, unit roots and forecasts.

Inputs are `Series`: one row per series and calendar step.  Window and grouped
expressions do the calendar work.  Unit roots, cointegration and autoregressions are
solved from lag sums of all blocks of a series (`lag_models`); the remaining fits run
one task per series, many series in parallel, on data bounded by the calendar.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.functions.dates import week_end
from tabulyte.functions.dist import normal_upper
from tabulyte.operators import smoothing
from tabulyte.operators.lag_models import BLOCK, on_gram, autoregression, most_lags, unit_root
from tabulyte.operators.series import TRADING_DAYS, Series


def resample_week(s: Series) -> DataFrame:
    """Sums per week ending on Sunday; weeks without rows are 0."""
    weekly = s.df.groupBy(*s.keys, week_end(s.time).alias("week")).agg(F.sum(s.value).alias("total"))
    ends = weekly.groupBy(*s.keys).agg(F.min("week").alias("a"), F.max("week").alias("b"))
    spine = ends.select(*s.keys, F.explode(F.sequence("a", "b", F.expr("INTERVAL 7 DAY"))).alias("week"))
    return spine.join(weekly, [*s.keys, "week"], "left").na.fill(0.0, ["total"])


def business_days(s: Series) -> DataFrame:
    """Monday-to-Friday calendar of each series, gaps filled from the day before."""
    ends = s.df.groupBy(*s.keys).agg(F.min(s.time).alias("a"), F.max(s.time).alias("b"))
    spine = ends.select(*s.keys, F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias(s.time)).filter(
        F.weekday(s.time) < 5
    )
    joined = spine.join(s.df.select(*s.keys, s.time, s.value), [*s.keys, s.time], "left")
    full = Series(joined, s.keys, s.time, s.value)
    return joined.withColumn(s.value, F.last(s.value, ignorenulls=True).over(full.so_far))


def _line(y: str, x: str, use: Column, w) -> tuple[Column, Column]:
    """Slope and intercept of a least-squares line over the marked rows of a window."""
    my, mx = F.avg(F.when(use, F.col(y))).over(w), F.avg(F.when(use, F.col(x))).over(w)
    xy = F.avg(F.when(use, F.col(x) * F.col(y))).over(w) - mx * my
    xx = F.avg(F.when(use, F.col(x) * F.col(x))).over(w) - mx * mx
    slope = xy / xx
    return slope, my - slope * mx


def decompose(s: Series, period: int, model: str = "additive", extrapolate: bool = False) -> DataFrame:
    """Trend by a centred moving average, seasonal means by position in the
    period, and the rest.  An even period halves the weight of both ends."""
    half = period // 2
    all_w = W.partitionBy(*s.keys)
    base = s.with_columns(_i=(F.row_number().over(s.w) - 1).cast("double"), _n=F.count(F.lit(1)).over(all_w))
    if period % 2:
        trend = F.avg(s.value).over(s.w.rowsBetween(-half, half))
    else:
        before = F.avg(s.value).over(s.w.rowsBetween(-half, half - 1))
        after = F.avg(s.value).over(s.w.rowsBetween(-half + 1, half))
        trend = (before + after) / 2
    inside = (F.col("_i") >= half) & (F.col("_i") < F.col("_n") - half)
    base = base.with_columns(trend=F.when(inside, trend))
    if extrapolate:
        first = (F.col("_i") >= half) & (F.col("_i") < half + period)
        last_i = F.col("_n") - half - 1
        last = (F.col("_i") >= last_i - period) & (F.col("_i") < last_i)
        fk, fn = _line("trend", "_i", first, all_w)
        lk, ln = _line("trend", "_i", last, all_w)
        base = base.with_columns(_fk=fk, _fn=fn, _lk=lk, _ln=ln)
        base = base.with_columns(trend=F.when(F.col("trend").isNotNull(), F.col("trend"))
                                 .when(F.col("_i") < half, F.col("_i") * F.col("_fk") + F.col("_fn"))
                                 .otherwise(F.col("_i") * F.col("_lk") + F.col("_ln")))
    x = F.col(s.value)
    add = model == "additive"
    base = base.with_columns(_phase=F.col("_i") % period, _d=x - F.col("trend") if add else x / F.col("trend"))
    means = base.df.groupBy(*s.keys, "_phase").agg(F.avg("_d").alias("_m"))
    centre = F.avg("_m").over(W.partitionBy(*s.keys))
    seasonal = means.select(*s.keys, "_phase", (F.col("_m") - centre if add else F.col("_m") / centre).alias("seasonal"))
    out = base.df.join(seasonal, [*s.keys, "_phase"])
    rest = x - F.col("trend") - F.col("seasonal") if add else x / (F.col("trend") * F.col("seasonal"))
    return out.select(*s.keys, s.time, s.value, "trend", "seasonal", rest.alias("resid"))


def variance_shares(parts: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """Population variance of each component as a percentage of the whole."""
    share = lambda c: (F.var_pop(c) * 100 / F.var_pop(value)).alias(f"{c}_pct")
    return parts.groupBy(*keys).agg(share("trend"), share("seasonal"), share("resid"))


def acf(s: Series, lags: int = 40) -> DataFrame:
    """Autocorrelation at each lag with the 95% band of Bartlett's formula.

    All lags come from one sorted pass: each row sees its earlier values through
    `lag`, and one aggregation sums the products.
    """
    mean = F.avg(s.value).over(W.partitionBy(*s.keys))
    c = s.with_columns(_c=F.col(s.value) - mean)
    c = c.with_columns(**{f"_l{k}": F.coalesce(F.lag("_c", k).over(s.w), F.lit(0.0)) for k in range(1, lags + 1)})
    sums = c.df.groupBy(*s.keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_c") * F.col("_c")).alias("0"),
        *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(str(k)) for k in range(1, lags + 1)],
    )
    long = sums.withColumn("_0", F.col("0")).unpivot([*s.keys, "n", "_0"], [str(k) for k in range(lags + 1)], "lag", "v")
    r = long.select(*s.keys, "n", F.col("lag").cast("int").alias("lag"), (F.col("v") / F.col("_0")).alias("acf"))
    earlier = W.partitionBy(*s.keys).orderBy("lag").rowsBetween(W.unboundedPreceding, -1)
    squares = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf")).otherwise(0.0)).over(earlier), F.lit(0.0))
    band = F.when(F.col("lag") > 0, 1.96 * F.sqrt((1 + 2 * squares) / F.col("n"))).otherwise(0.0)
    return r.withColumn("band", band).drop("n")


def pacf(s: Series, lags: int = 40) -> DataFrame:
    """Partial autocorrelation by the Durbin-Levinson recursion on the ACF table."""
    def recurse(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.sort_values("lag")["acf"].to_numpy()
        phi, out = np.zeros(0), [1.0]
        for k in range(1, len(r)):
            last = (r[k] - phi @ r[k - 1:0:-1]) / (1 - phi @ r[1:k])
            phi = np.append(phi - last * phi[::-1], last)
            out.append(last)
        return pdf.sort_values("lag").assign(pacf=out).drop(columns=["acf", "band"])

    table = acf(s, lags)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema if f.name not in ("acf", "band"))
    return table.groupBy(*s.keys).applyInPandas(recurse, f"{fields}, pacf double")


# Published response surface of unit-root p-values (constant
# term, one and two series): bounds, turning point, and the two polynomials.
UNIT_ROOT_P = {
    1: (-18.83, 2.74, -1.61, (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)),
    2: (-18.86, 0.92, -2.62, (2.92, 1.5012, 0.039796), (2.1945, 0.64695, -0.29198, -0.042377)),
}


def unit_root_p(stat: float, series: int = 1) -> float:
    low, high, turn, small, large = UNIT_ROOT_P[series]
    if stat > high:
        return 1.0
    if stat < low:
        return 0.0
    z = sum(c * stat**i for i, c in enumerate(small if stat <= turn else large))
    return normal_upper(-z)


def _per_series(s: Series, fit, fields: str) -> DataFrame:
    """Run a fit once per series on its ordered values."""
    key_fields = ", ".join(f"{k} {s.df.schema[k].dataType.simpleString()}" for k in s.keys)
    keys, time, value = list(s.keys), s.time, s.value

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = fit(pdf.sort_values(time)[value].dropna().to_numpy(dtype=float))
        for i, k in enumerate(keys):
            out.insert(i, k, key[i])
        return out

    return s.df.select(*keys, time, value).groupBy(*keys).applyInPandas(run, f"{key_fields}, {fields}")


def _test_row(row, constant: bool, series: int) -> pd.DataFrame:
    found = unit_root(row, constant)
    if found is None:
        return pd.DataFrame([{"stat": None, "p_value": None, "lags": None, "n": None}], dtype=object)
    p = unit_root_p(found[0], series)
    return pd.DataFrame([{"stat": found[0], "p_value": p, "lags": found[1], "n": found[2]}])


TEST = "stat double, p_value double, lags int, n int"


def adf(s: Series, block: int = BLOCK) -> DataFrame:
    """Unit-root test per series with the verdict at 5%; null where a series is too short."""
    # the test with a constant is the same for any origin: near the mean its sums are exact
    out = on_gram(s.df, s.keys, s.time, s.value, most_lags, lambda r: _test_row(r, True, 1), TEST, centred=True, block=block)
    return out.withColumn("stationary", F.col("p_value") < 0.05)


def cointegration(df: DataFrame, keys: tuple[str, ...], time: str, a: str, b: str) -> DataFrame:
    """Engle-Granger: regress a on b, test the residual, and mark the spread's
    2-sigma bands; one row per key, with the regression from Spark aggregates."""
    ab = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    line = ab.groupBy(*keys).agg(F.regr_slope(a, b).alias("slope"), F.regr_intercept(a, b).alias("intercept"))
    spread = ab.join(line, list(keys)).withColumn("spread", F.col(a) - F.col("slope") * F.col(b) - F.col("intercept"))
    bands = spread.groupBy(*keys, "slope", "intercept").agg(
        F.avg("spread").alias("mean"), F.stddev_samp("spread").alias("sd"), F.max_by("spread", time).alias("last")
    ).withColumn("signal", F.when(F.col("last") > F.col("mean") + 2 * F.col("sd"), "short")
                 .when(F.col("last") < F.col("mean") - 2 * F.col("sd"), "long").otherwise("none"))

    test = on_gram(spread, keys, time, "spread", most_lags, lambda r: _test_row(r, False, 2), TEST).drop("n")
    return bands.join(test, list(keys))


def holt_winters(s: Series, period: int = 7, horizon: int = 30, block: int = smoothing.BLOCK) -> DataFrame:
    """Forecast per series with a ±1.96·RMSE band."""
    return smoothing.holt_winters(s.df, s.keys, s.time, s.value, period, horizon, block)


def holdout(s: Series, last: int = 8) -> DataFrame:
    """Mark the last rows of each series as the test part."""
    back = F.row_number().over(W.partitionBy(*s.keys).orderBy(F.desc(s.time)))
    return s.df.withColumn("is_test", back <= last)


def naive_forecast(s: Series, window: int = 7, horizon: int = 30) -> DataFrame:
    """The mean of the last rows, repeated after the last date."""
    back = F.row_number().over(W.partitionBy(*s.keys).orderBy(F.desc(s.time)))
    tail = s.df.withColumn("_b", back).filter(F.col("_b") <= window)
    level = tail.groupBy(*s.keys).agg(F.avg(s.value).alias("forecast"), F.max(s.time).alias("_last"))
    return level.select(
        *s.keys, F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))).alias(s.time), "forecast"
    )


def arima(s: Series, lags: int = 5, horizon: int = 30, block: int = BLOCK) -> DataFrame:
    """Autoregression of first differences by conditional least squares, forecast
    recursively and summed back; null forecasts where a series is shorter than its lags need."""
    return on_gram(s.df, s.keys, s.time, s.value, lambda n: F.lit(lags), lambda r: autoregression(r, lags, horizon), "step int, forecast double, sigma double", block=block)


def garch_path(r2: np.ndarray, omega, alpha, beta) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood (up to a constant) and last variance for many parameters at once."""
    var = np.full(np.shape(alpha), r2.mean())
    ll = np.zeros(np.shape(alpha))
    for v in r2:
        ll -= 0.5 * (np.log(var) + v / var)
        var = omega + alpha * v + beta * var
    return ll, var


def garch(s: Series, rounds: int = 4, short_volatility: bool = False) -> DataFrame:
    """GARCH(1,1) of zero-mean percentage returns: likelihood search with the long-run
    variance held at the sample one.  Below 100 returns nothing is fitted and all is
    null; `short_volatility` asks for the 21-row volatility in its place."""
    def fit(x):
        r = 100 * (x[1:] / x[:-1] - 1)
        if len(r) < 100:
            return pd.DataFrame([{"omega": None, "alpha": None, "beta": None, "persistence": None,
                                  "volatility": float(np.std(r[-21:], ddof=1)) if short_volatility and len(r) > 1 else None, "fitted": False}])
        r2, v = r * r, float((r * r).mean())
        lo, hi = np.array([0.001, 0.001]), np.array([0.5, 0.998])
        for _ in range(rounds):
            a, b = (m.ravel() for m in np.meshgrid(np.linspace(lo[0], hi[0], 21), np.linspace(lo[1], hi[1], 21)))
            ok = a + b < 0.9999
            a, b = a[ok], b[ok]
            ll, last = garch_path(r2, v * (1 - a - b), a, b)
            i = int(np.argmax(ll))
            width = (hi - lo) / 10
            lo = np.maximum([a[i], b[i]] - width, 1e-6)
            hi = np.minimum([a[i], b[i]] + width, [0.999, 0.999])
        return pd.DataFrame([{"omega": v * (1 - a[i] - b[i]), "alpha": a[i], "beta": b[i], "persistence": a[i] + b[i],
                              "volatility": math.sqrt(last[i]), "fitted": True}])

    return _per_series(s, fit, "omega double, alpha double, beta double, persistence double, volatility double, fitted boolean")


def sharpe(s: Series, ret: str) -> DataFrame:
    """Annualised return and Sharpe ratio per series."""
    return s.df.groupBy(*s.keys).agg(
        (F.avg(ret) * TRADING_DAYS).alias("annual_return"),
        (F.sqrt(F.lit(TRADING_DAYS)) * F.avg(ret) / F.stddev_samp(ret)).alias("sharpe"),
    )
