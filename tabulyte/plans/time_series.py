"""Time-series operators over daily rates and daily order volume."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.operators import series as se, timeseries as ts
from tabulyte.operators.timeseries import UNIT_ROOT_P
from tabulyte.plans.registry import query
from tabulyte.plans.tails import normal_tails
from tabulyte.plans.stand_ins import DAILY_SQL, FX_SQL, daily, fx
from tabulyte.plans.windows import RET_SQL, SO_FAR


def returns(t):
    s = fx(t)
    r = s.with_columns(ret=se.pct_change(s))
    return se.Series(r.df.filter("ret IS NOT NULL"), s.keys, s.time, "ret")


@query(
    "ts_resample_week",
    f"""WITH w AS (SELECT pair, CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS week, sum(rate) AS total FROM {FX_SQL} GROUP BY ALL),
             s AS (SELECT pair, CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM w GROUP BY pair)
        SELECT pair, week, coalesce(total, 0) AS total FROM s LEFT JOIN w USING (pair, week)""",
    {6: "total"},
)
def ts_resample_week(t):
    return ts.resample_week(fx(t))


@query(
    "ts_asfreq_bday",
    f"""WITH f AS MATERIALIZED (SELECT * FROM {FX_SQL}),
             s AS (SELECT pair, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM f GROUP BY pair),
             b AS (SELECT s.pair, s.d, f.rate FROM s LEFT JOIN f USING (pair, d) WHERE isodow(s.d) < 6)
        SELECT pair, d, last_value(rate IGNORE NULLS) {SO_FAR} AS rate FROM b""",
)
def ts_asfreq_bday(t):
    return ts.business_days(fx(t))


def decompose_sql(period, source, key, time, value, model, extrapolate):
    half = period // 2
    part = f"PARTITION BY {key}"
    win = lambda a, b: f"avg({value}) OVER ({part} ORDER BY {time} ROWS BETWEEN {a} PRECEDING AND {b} FOLLOWING)"
    trend = win(half, half) if period % 2 else f"({win(half, half - 1)} + {win(half - 1, half)}) / 2"
    first, last = f"i >= {half} AND i < {half + period}", f"i >= n - {half} - 1 - {period} AND i < n - {half} - 1"
    fit = lambda rows: f"(regr_slope(t, i) FILTER ({rows}) OVER ({part}) * i + regr_intercept(t, i) FILTER ({rows}) OVER ({part}))"
    full = f"coalesce(t, CASE WHEN i < {half} THEN {fit(first)} ELSE {fit(last)} END)" if extrapolate else "t"
    op, back = ("-", "x - t - s") if model == "additive" else ("/", "x / (t * s)")
    return f"""(WITH o AS (SELECT {key} AS k, {time} AS d, {value} AS x, row_number() OVER ({part} ORDER BY {time}) - 1 AS i,
             count(*) OVER ({part}) AS n, {trend} AS t FROM {source}),
        m AS (SELECT k AS {key}, d, x, i, n, CASE WHEN i >= {half} AND i < n - {half} THEN t END AS t FROM o),
        e AS (SELECT {key} AS k, d, x, i % {period} AS ph, {full} AS t FROM m),
        p AS (SELECT k, ph, avg(x {op} t) AS m FROM e GROUP BY ALL), q AS (SELECT k, ph, m {op} avg(m) OVER (PARTITION BY k) AS s FROM p)
        SELECT k AS {key}, d AS {time}, x AS {value}, t AS trend, s AS seasonal, {back} AS resid FROM e JOIN q USING (k, ph))"""


DAILY_SERIES_SQL = f"(SELECT 'orders' AS series, * FROM {DAILY_SQL})"
ADD_SQL = decompose_sql(7, DAILY_SERIES_SQL, "series", "day", "volume", "additive", True)


@query(
    "ts_decompose_add",
    f"""WITH d AS MATERIALIZED (SELECT * FROM {ADD_SQL})
        SELECT day, trend, seasonal, resid, (SELECT var_pop(trend) * 100 / var_pop(volume) FROM d) AS trend_pct,
               (SELECT var_pop(seasonal) * 100 / var_pop(volume) FROM d) AS seasonal_pct,
               (SELECT var_pop(resid) * 100 / var_pop(volume) FROM d) AS resid_pct FROM d""",
    {2: "trend seasonal resid", 6: "trend_pct seasonal_pct resid_pct"},
)
def ts_decompose_add(t):
    s = daily(t)
    parts = ts.decompose(s, 7, extrapolate=True)
    names = ["trend_pct", "seasonal_pct", "resid_pct"]
    shares = ts.variance_shares(parts, s.keys, s.value).select(F.struct(*names)).scalar()
    return parts.withColumn("_s", shares).select("day", "trend", "seasonal", "resid", *[f"_s.{n}" for n in names])


@query(
    "ts_decompose_mult",
    f"SELECT pair, d, trend, seasonal, resid FROM {decompose_sql(252, FX_SQL, 'pair', 'd', 'rate', 'multiplicative', False)}",
    {10: "trend", 8: "seasonal resid"},
)
def ts_decompose_mult(t):
    return ts.decompose(fx(t), 252, "multiplicative").drop("rate")


def _unit_root_sql(source: str, constant: bool, series: int, most: int = 30) -> str:
    """Sums of products over all lags, elimination lag by lag for the order with the least
    AIC, and again over that order's own rows."""
    w = "OVER (PARTITION BY pair ORDER BY d)"
    y = most + 3
    lags = ", ".join(f"coalesce(lag(c, {k}) {w}, 0)" for k in range(1, most + 1))
    gram = f"""SELECT pair, list(g ORDER BY a) AS m FROM (
        SELECT pair, a, list(s ORDER BY b) AS g FROM (
          SELECT v.pair, a, b, sum(v[a] * v[b]) AS s FROM v JOIN $ USING (pair), range(1, {y + 1}) p(a), range(1, {y + 1}) q(b) WHERE i > skip + 1 GROUP BY ALL)
        GROUP BY pair, a) GROUP BY pair"""
    swept = f"list_transform(range(1, {y + 1}), lambda i: list_transform(range(1, {y + 1}), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]))"
    low, high, turn, small, large = UNIT_ROOT_P[series]
    first, terms = (1, 2) if constant else (2, 1)  # without a constant its column stays out
    z = "CASE WHEN stat <= {} THEN {} ELSE {} END".format(turn, *[" + ".join(f"{c} * power(stat, {i})" for i, c in enumerate(cs)) for cs in (small, large)])
    p = f"CASE WHEN stat > {high} THEN 1.0 WHEN stat < {low} THEN 0.0 WHEN z < 0 THEN ({normal_tails('z')}) / 2 ELSE 1 - ({normal_tails('z')}) / 2 END"
    return f"""WITH RECURSIVE f AS (SELECT pair, d, x, row_number() {w} AS i, x - lag(x) {w} AS c FROM ({source})),
      v AS MATERIALIZED (SELECT pair, i, [1.0, lag(x) {w}, {lags}, c] AS v FROM f),
      n AS (SELECT pair, count(*) AS n, greatest(0, least(ceil(12 * power(count(*) / 100, 0.25)), count(*) // 2 - 2))::BIGINT AS skip FROM f GROUP BY pair),
      g AS MATERIALIZED ({gram.replace("$", "n")}),
      e(pair, k, m) AS (SELECT pair, {first}::BIGINT, m FROM g UNION ALL SELECT pair, k + 1, {swept} FROM e JOIN n USING (pair) WHERE k <= skip + 2),
      orders AS (SELECT pair, k - 3 AS p, m[{y}][{y}] AS sse, n - 1 - skip AS rows FROM e JOIN n USING (pair) WHERE k >= 3),
      best AS MATERIALIZED (SELECT pair, arg_min(p, rows * (ln(2 * pi() * sse / rows) + 1) + 2 * (p + {terms})) AS skip FROM orders GROUP BY pair),
      h AS MATERIALIZED ({gram.replace("$", "best")}),
      t(pair, step, k, m) AS (SELECT pair, {first}::BIGINT, {1 if constant else 3}::BIGINT, m FROM h UNION ALL SELECT pair, step + 1, step + 2, {swept} FROM t JOIN best USING (pair) WHERE step <= skip + 1),
      r AS (SELECT pair, skip AS lags, n - 1 - skip AS n, m[2][2] AS xx, m[2][{y}] AS xy, m[{y}][{y}] AS yy FROM t JOIN best USING (pair) JOIN (SELECT pair, n FROM n) USING (pair) WHERE step = skip + 2),
      s AS (SELECT pair, lags, n, CASE WHEN n - lags > {terms} THEN xy / xx / sqrt((yy - xy * xy / xx) / (n - lags - {terms}) / xx) END AS stat FROM r),
      zs AS (SELECT *, {z} AS z FROM s)
      SELECT pair, stat, {p} AS p_value, CASE WHEN stat IS NOT NULL THEN lags END AS lags, CASE WHEN stat IS NOT NULL THEN n END AS n, {p} < 0.05 AS stationary FROM zs"""


CENTRED_SQL = f"SELECT pair, d, rate - avg(rate) OVER (PARTITION BY pair) AS x FROM {FX_SQL}"


@query("ts_adf", _unit_root_sql(CENTRED_SQL, True, 1), {6: "stat", 7: "p_value"})
def ts_adf(t):
    return ts.adf(fx(t))


RATE_SQL = "(1000000 + sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (o_orderstatus = '$') // (count(*) FILTER (o_orderstatus = '$') * 500)) / 1000000"
WIDE_SQL = f"""(SELECT * FROM (SELECT o_orderpriority AS pair, CAST(o_orderdate AS DATE) AS d, {RATE_SQL.replace("$", "F")} AS a, {RATE_SQL.replace("$", "O")} AS b
  FROM orders GROUP BY ALL) WHERE a IS NOT NULL AND b IS NOT NULL)"""
SPREAD_SQL = f"""(SELECT pair, d, slope, intercept, a - slope * b - intercept AS x FROM {WIDE_SQL}
  JOIN (SELECT pair, regr_slope(a, b) AS slope, regr_intercept(a, b) AS intercept FROM {WIDE_SQL} GROUP BY pair) USING (pair))"""


@query(
    "ts_coint",
    f"""SELECT *, CASE WHEN last > mean + 2 * sd THEN 'short' WHEN last < mean - 2 * sd THEN 'long' ELSE 'none' END AS signal
        FROM (SELECT pair, slope, intercept, avg(x) AS mean, stddev_samp(x) AS sd, arg_max(x, d) AS last FROM {SPREAD_SQL} GROUP BY pair, slope, intercept)
        LEFT JOIN (SELECT pair, stat, p_value, lags FROM ({_unit_root_sql("SELECT pair, d, x FROM " + SPREAD_SQL, False, 2)})) USING (pair)""",
    {9: "slope intercept mean sd last", 6: "stat", 7: "p_value"},
)
def ts_coint(t):
    rate = F.expr("(1000000 + sum(cast(round(o_totalprice * 100) AS bigint)) div (count(1) * 500)) / 1000000")
    wide = (
        t.orders.groupBy(F.col("o_orderpriority").alias("pair"), F.to_date("o_orderdate").alias("d"))
        .pivot("o_orderstatus", ["F", "O"]).agg(rate)
        .select("pair", "d", F.col("F").alias("a"), F.col("O").alias("b"))
    )
    return ts.cointegration(wide, ("pair",), "d", "a", "b")


ACF_SQL = f"""(WITH c AS (SELECT pair, row_number() OVER (PARTITION BY pair ORDER BY d) AS i, rate - avg(rate) OVER (PARTITION BY pair) AS c FROM {FX_SQL}),
  z AS (SELECT pair, count(*) AS n, sum(c * c) AS v FROM c GROUP BY pair),
  r AS (SELECT a.pair, l.lag, sum(a.c * b.c) AS s FROM (SELECT unnest(range(41)) AS lag) l, c a JOIN c b ON a.pair = b.pair AND b.i = a.i - lag GROUP BY ALL),
  q AS (SELECT pair, lag, n, s / v AS acf FROM r JOIN z USING (pair))
  SELECT pair, lag, acf, CASE WHEN lag > 0 THEN 1.96 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf ELSE 0 END)
         OVER (PARTITION BY pair ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) ELSE 0 END AS band FROM q)"""


@query("ts_acf", f"SELECT * FROM {ACF_SQL}", {8: "acf band"})
def ts_acf(t):
    return ts.acf(fx(t))


@query(
    "ts_pacf",
    f"""WITH RECURSIVE a AS (SELECT pair, list(acf ORDER BY lag) AS r FROM {ACF_SQL} GROUP BY pair),
          p(pair, k, phi, last, r) AS (
            SELECT pair, 0::BIGINT, []::DOUBLE[], 1.0::DOUBLE, r FROM a
            UNION ALL
            SELECT pair, k + 1, list_append(list_transform(range(1, k + 1), lambda i: phi[i] - step * phi[k + 1 - i]), step), step, r
            FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[k + 2 - i])), 0))
                            / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[i + 1])), 0)) AS step
                  FROM p WHERE k < 40))
        SELECT pair, k AS lag, last AS pacf FROM p""",
    {6: "pacf"},
)
def ts_pacf(t):
    return ts.pacf(fx(t))


@query("ts_holt_winters")
def ts_holt_winters(t):
    return ts.holt_winters(daily(t), 7, 30)


@query(
    "ts_holdout",
    f"SELECT pair, d, row_number() OVER (PARTITION BY pair ORDER BY d DESC) <= 8 AS is_test FROM {FX_SQL}",
)
def ts_holdout(t):
    return ts.holdout(fx(t)).drop("rate")


@query(
    "ts_naive_forecast",
    f"""WITH f AS MATERIALIZED (SELECT * FROM {FX_SQL}), k AS (SELECT pair, avg(rate) AS forecast, max(d) AS last FROM
          (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY pair ORDER BY d DESC) <= 7) GROUP BY pair)
        SELECT pair, CAST(unnest(generate_series(last + INTERVAL 1 DAY, last + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS d, forecast FROM k""",
    {8: "forecast"},
)
def ts_naive_forecast(t):
    return ts.naive_forecast(fx(t))


def _arima_sql(lags: int = 5, horizon: int = 30) -> str:
    """Sums of lag products, elimination, and the recursion of the forecasts."""
    w = "OVER (PARTITION BY pair ORDER BY d)"
    row = ", ".join([*[f"lag(c, {k}) {w}" for k in range(1, lags + 1)], "c"])
    size = lags + 1
    sums = ", ".join("[" + ", ".join(f"sum(v[{i}] * v[{j}])" for j in range(1, size + 1)) + "]" for i in range(1, size + 1))
    betas = ", ".join(f"m[{i}][{size}]" for i in range(1, size))
    return f"""WITH RECURSIVE f AS MATERIALIZED (SELECT pair, d, rate, row_number() {w} AS i, rate - lag(rate) {w} AS c FROM {FX_SQL}),
      v AS (SELECT pair, i, [{row}] AS v FROM f),
      g AS (SELECT pair, count(*) AS n, [{sums}] AS m FROM v WHERE i > {size} GROUP BY pair),
      e(pair, n, k, m) AS (SELECT pair, n, 1::BIGINT, m FROM g UNION ALL
        SELECT pair, n, k + 1, list_transform(range(1, {size + 1}), lambda i: list_transform(range(1, {size + 1}), lambda j:
          CASE WHEN i = k THEN m[k][j] / m[k][k] ELSE m[i][j] - m[i][k] * m[k][j] / m[k][k] END)) FROM e WHERE k <= {lags}),
      b AS (SELECT pair, [{betas}] AS b, sqrt(m[{size}][{size}] / n) AS sigma FROM e WHERE k = {size}),
      s(pair, step, forecast, past, b, sigma) AS (
        SELECT pair, 0::INTEGER, arg_max(rate, i), list(c ORDER BY i DESC)[1:{lags}], any_value(b), any_value(sigma) FROM f JOIN b USING (pair) GROUP BY pair
        UNION ALL SELECT pair, step + 1, forecast + list_inner_product(b, past), list_prepend(list_inner_product(b, past), past[1:{lags - 1}]), b, sigma FROM s WHERE step < {horizon})
      SELECT pair, step, forecast, sigma FROM s WHERE step > 0"""


@query("ts_arima", _arima_sql(), {8: "forecast sigma"})
def ts_arima(t):
    return ts.arima(fx(t))


@query("ts_garch")
def ts_garch(t):
    return ts.garch(fx(t))


@query(
    "ts_sharpe",
    f"SELECT pair, avg(ret) * 252 AS annual_return, sqrt(252) * avg(ret) / stddev_samp(ret) AS sharpe FROM {RET_SQL} GROUP BY pair",
    {8: "annual_return", 7: "sharpe"},
)
def ts_sharpe(t):
    return ts.sharpe(returns(t), "ret")
