"""Window indicators of time series.

A series holds one row per calendar day or hour (aggregate to that grain first),
so a window over one series is bounded by the calendar, not by the row count.
Row-level ranks and running shares are in `ranks` and use blocked orders.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.operators.recurrence import exponential_means

TRADING_DAYS = 252


@dataclass(frozen=True)
class Series:
    """A long table of series: key columns, the time column and the value."""

    df: DataFrame
    keys: tuple[str, ...]
    time: str
    value: str

    @property
    def w(self):
        return W.partitionBy(*self.keys).orderBy(self.time)

    def last_n(self, n: int):
        return self.w.rowsBetween(-(n - 1), 0)

    @property
    def so_far(self):
        return self.w.rowsBetween(W.unboundedPreceding, 0)

    def with_columns(self, **cols: Column) -> "Series":
        return Series(self.df.withColumns(cols), self.keys, self.time, self.value)

    def of(self, value: str) -> "Series":
        return Series(self.df, self.keys, self.time, value)


def pct_change(s: Series, pad: bool = False) -> Column:
    """Relative change from the previous row; `pad` carries over nulls first."""
    value = F.last(s.value, ignorenulls=True).over(s.so_far) if pad else F.col(s.value)
    if not pad:
        return F.try_divide(value, F.lag(s.value).over(s.w)) - 1
    before = F.last(s.value, ignorenulls=True).over(s.w.rowsBetween(W.unboundedPreceding, -1))
    return F.try_divide(value, before) - 1


def log_return(s: Series) -> Column:
    return F.ln(F.try_divide(F.col(s.value), F.lag(s.value).over(s.w)))


def diff(s: Series) -> Column:
    return F.col(s.value) - F.lag(s.value).over(s.w)


def rolling(s: Series, n: int, fn=F.avg) -> Column:
    """Statistic of the last n rows; null until all n are there and not null."""
    frame = s.last_n(n)
    return F.when(F.count(s.value).over(frame) == n, fn(s.value).over(frame))


def rolling_volatility(s: Series, n: int) -> Column:
    return rolling(s, n, F.stddev_samp) * F.sqrt(F.lit(TRADING_DAYS))


def bollinger(s: Series, n: int = 20, width: float = 2.0, mode: str = "price") -> DataFrame:
    """Bands around the rolling mean and the signal at a breach: 1 below, -1 above.

    `price` uses the standard deviation of the values; `annualised` adds the
    yearly deviation of the returns to the price.
    """
    df = s.with_columns(ret=pct_change(s))
    middle = rolling(df, n)
    spread = rolling(df, n, F.stddev_samp) if mode == "price" else rolling_volatility(df.of("ret"), n)
    out = df.df.withColumns({"middle": middle, "_spread": spread}).withColumns(
        {"lower": F.col("middle") - width * F.col("_spread"), "upper": F.col("middle") + width * F.col("_spread")}
    )
    signal = F.when(F.col(s.value) < F.col("lower"), 1).when(F.col(s.value) > F.col("upper"), -1).otherwise(0)
    return out.withColumn("signal", signal).drop("_spread", "ret")


def rsi(s: Series, n: int = 14) -> DataFrame:
    """Relative strength from plain rolling means of gains and losses."""
    d = diff(s)
    step = s.with_columns(_gain=F.when(d.isNotNull(), F.greatest(d, F.lit(0.0))),
                          _loss=F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0))))
    out = step.df.withColumns({"_g": rolling(step.of("_gain"), n), "_l": rolling(step.of("_loss"), n)})
    strength = F.when((F.col("_l") == 0) & (F.col("_g") > 0), F.lit(100.0)).otherwise(
        100 - 100 / (1 + F.try_divide(F.col("_g"), F.col("_l")))
    )
    return out.withColumn("rsi", strength).drop("_gain", "_loss", "_g", "_l")


def ewm(s: Series, spans: dict[str, int]) -> DataFrame:
    """Recursive exponential means `y = a*x + (1-a)*y_prev`, `a = 2/(span+1)`, as a scan
    over blocks of rows.  Rows without a value have no mean and change none."""
    return exponential_means(s.df, s.keys, s.time, {n: (s.value, 2.0 / (k + 1)) for n, k in spans.items()})


def macd(s: Series, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    first = ewm(s, {"ema_fast": fast, "ema_slow": slow}).withColumn("macd", F.col("ema_fast") - F.col("ema_slow"))
    second = ewm(Series(first, s.keys, s.time, "macd"), {"signal": signal})
    return second.withColumn("state", F.when(F.col("macd") > F.col("signal"), "BUY").otherwise("SELL"))


def crossovers(s: Series, fast: int = 20, slow: int = 50) -> DataFrame:
    """How often the fast rolling mean crosses the slow one, each way."""
    m = s.with_columns(_f=rolling(s, fast), _s=rolling(s, slow))
    m = m.with_columns(_pf=F.lag("_f").over(s.w), _ps=F.lag("_s").over(s.w))
    up = (F.col("_f") > F.col("_s")) & (F.col("_pf") <= F.col("_ps"))
    down = (F.col("_f") < F.col("_s")) & (F.col("_pf") >= F.col("_ps"))
    return m.df.groupBy(*s.keys).agg(F.count_if(up).alias("buys"), F.count_if(down).alias("sells"))


def drawdown(s: Series) -> DataFrame:
    peak = F.max(s.value).over(s.so_far)
    out = s.df.withColumn("drawdown", F.try_divide(F.col(s.value) - peak, peak))
    return out.groupBy(*s.keys).agg(
        F.min("drawdown").alias("max_drawdown"), F.max_by("drawdown", s.time).alias("current_drawdown")
    )


def forward_fill(s: Series) -> Column:
    return F.last(s.value, ignorenulls=True).over(s.so_far)


def interpolate(s: Series) -> DataFrame:
    """Linear by row position; leading nulls stay, trailing ones hold the last value."""
    at = F.row_number().over(s.w)
    known = s.with_columns(_pos=at)
    known = known.with_columns(_kpos=F.when(F.col(s.value).isNotNull(), F.col("_pos")))
    back = W.partitionBy(*s.keys).orderBy(F.desc(s.time)).rowsBetween(W.unboundedPreceding, 0)
    cols = {
        "_a": F.last(s.value, ignorenulls=True).over(s.so_far),
        "_pa": F.last("_kpos", ignorenulls=True).over(s.so_far),
        "_b": F.last(s.value, ignorenulls=True).over(back),
        "_pb": F.last("_kpos", ignorenulls=True).over(back),
    }
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_pos") - F.col("_pa")) / (F.col("_pb") - F.col("_pa"))
    filled = (
        F.when(F.col(s.value).isNotNull(), F.col(s.value))
        .when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), between)
        .otherwise(F.col("_a"))
    )
    return known.df.withColumns(cols).withColumn("filled", filled).drop("_pos", "_kpos", *cols)


def cusum(s: Series, slack: float = 0.5, threshold: float = 4.0) -> DataFrame:
    """Two-sided cumulative sums from the second row on, and the breaches.

    `max(0, S + step)` equals the running sum minus its running minimum (with the
    start at 0), so no sequential pass is needed.
    """
    all_w = W.partitionBy(*s.keys)
    base = s.with_columns(_m=F.avg(s.value).over(all_w), _sd=F.stddev_samp(s.value).over(all_w),
                          _i=F.row_number().over(s.w))
    x, m, k = F.col(s.value), F.col("_m"), slack * F.col("_sd")
    later = F.col("_i") > 1
    steps = base.with_columns(_up=F.when(later, x - m - k).otherwise(0.0), _dn=F.when(later, m - x - k).otherwise(0.0))
    sums = steps.with_columns(_cu=F.sum("_up").over(s.so_far), _cd=F.sum("_dn").over(s.so_far))
    out = sums.df.withColumns({
        "cusum_pos": F.col("_cu") - F.least(F.min("_cu").over(s.so_far), F.lit(0.0)),
        "cusum_neg": F.col("_cd") - F.least(F.min("_cd").over(s.so_far), F.lit(0.0)),
    })
    breach = F.abs(F.col("cusum_pos") - F.col("cusum_neg")) > threshold * F.col("_sd")
    return out.withColumn("breach", breach).drop("_m", "_sd", "_i", "_up", "_dn", "_cu", "_cd")


def split_scores(s: Series, min_gap: int = 50) -> DataFrame:
    """For every split of a series, the two-sample t of the parts before and after."""
    x = F.col(s.value)
    all_w = W.partitionBy(*s.keys)
    p = s.with_columns(
        _n1=F.row_number().over(s.w) - 1, _n=F.count(s.value).over(all_w),
        _s1=F.sum(s.value).over(s.so_far) - x, _q1=F.sum(x * x).over(s.so_far) - x * x,
        _s=F.sum(s.value).over(all_w), _q=F.sum(x * x).over(all_w),
    ).df
    p = p.filter((F.col("_n1") >= min_gap) & (F.col("_n1") < F.col("_n") - min_gap))
    n1, n2 = F.col("_n1"), F.col("_n") - F.col("_n1")
    m1, m2 = F.col("_s1") / n1, (F.col("_s") - F.col("_s1")) / n2
    v1 = (F.col("_q1") - n1 * m1 * m1) / (n1 - 1)
    v2 = (F.col("_q") - F.col("_q1") - n2 * m2 * m2) / (n2 - 1)
    t = F.abs(m1 - m2) / (F.sqrt(v1 / n1 + v2 / n2) + 1e-12)
    return p.select(*s.keys, s.time, n1.cast("bigint").alias("split"), t.alias("t"))


def change_points(s: Series, min_gap: int = 50, at_most: int = 8, min_t: float = 2.0) -> DataFrame:
    """Up to `at_most` splits by largest t, at least `min_gap` rows apart."""
    scores = split_scores(s, min_gap)

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        rest = pdf[pdf["t"] >= min_t].sort_values(["t", "split"], ascending=[False, True])
        chosen = []
        while len(rest) and len(chosen) < at_most:
            best = rest.iloc[0]
            chosen.append(best.name)
            rest = rest[(rest["split"] - best["split"]).abs() >= min_gap]
        return pdf.loc[chosen]

    return scores.groupBy(*s.keys).applyInPandas(pick, scores.schema)


def backtest(s: Series, fast: int = 50, slow: int = 200, capital: float = 10_000.0, fee: float = 0.0005) -> DataFrame:
    """Long or short by the order of two rolling means, with a cost on turnover.

    Equity is a running product of daily growth factors.
    """
    m = s.with_columns(_f=rolling(s, fast), _s=rolling(s, slow))
    m = Series(m.df.filter("_f IS NOT NULL AND _s IS NOT NULL"), s.keys, s.time, s.value)
    m = m.with_columns(signal=F.when(F.col("_f") > F.col("_s"), 1.0).otherwise(-1.0))
    held = F.lag("signal").over(m.w)
    cost = F.abs(F.col("signal") - held) / 2 * fee
    m = m.with_columns(_growth=F.coalesce(1 + held * pct_change(m) - cost, F.lit(1.0)))
    m = m.with_columns(
        equity=F.lit(capital) * F.product("_growth").over(m.so_far),
        buy_hold=F.lit(capital) * F.col(s.value) / F.first(s.value).over(m.so_far),
    )
    return m.with_columns(strategy_return=F.col("_growth") - 1).df.drop("_f", "_s", "_growth")


def backtest_summary(bt: DataFrame, s: Series, capital: float = 10_000.0) -> DataFrame:
    peak = F.max("equity").over(W.partitionBy(*s.keys).orderBy(s.time).rowsBetween(W.unboundedPreceding, 0))
    marked = bt.withColumn("_dd", (peak - F.col("equity")) / peak)
    return marked.groupBy(*s.keys).agg(
        (F.max_by("equity", s.time) / capital - 1).alias("total_return"),
        (F.max_by("buy_hold", s.time) / capital - 1).alias("buy_hold_return"),
        sharpe_of("strategy_return").alias("sharpe"),
        F.max("_dd").alias("max_drawdown"),
    )


def sharpe_of(ret: str) -> Column:
    return F.sqrt(F.lit(TRADING_DAYS)) * F.avg(ret) / (F.stddev_samp(ret) + 1e-12)


def half_split(s: Series) -> DataFrame:
    """Flag the rows from the middle row on."""
    pos = F.row_number().over(s.w) - 1
    n = F.count(F.lit(1)).over(W.partitionBy(*s.keys))
    return s.df.withColumn("late", pos >= F.floor(n / 2))


def last_value(s: Series) -> DataFrame:
    return s.df.groupBy(*s.keys).agg(F.max_by(s.value, s.time).alias("last"))


def ranked_groups(groups: DataFrame, value: str, ties: Sequence[str]) -> DataFrame:
    """Rank of result-sized group rows, largest first."""
    return groups.withColumn("rank", F.row_number().over(W.orderBy(F.desc(value), *ties)))
