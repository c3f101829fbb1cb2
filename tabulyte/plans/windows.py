"""Window and ordered functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.operators import aggregates as ag, ranks, series as se
from tabulyte.plans.registry import query
from tabulyte.plans.stand_ins import DAILY_SQL, FX_SQL, GAPPY_SQL, daily, fx, gappy

OVER = "OVER (PARTITION BY pair ORDER BY d)"


def frame(n):
    return f"OVER (PARTITION BY pair ORDER BY d ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


SO_FAR = "OVER (PARTITION BY pair ORDER BY d ROWS UNBOUNDED PRECEDING)"


def rolled(fn, col, n):
    return f"CASE WHEN count({col}) {frame(n)} = {n} THEN {fn}({col}) {frame(n)} END"


def add(s, **cols):
    return s.with_columns(**cols).df


RET_SQL = f"(SELECT *, rate / lag(rate) {OVER} - 1 AS ret FROM {FX_SQL})"


@query(
    "win_pct_change",
    f"""SELECT pair, d, rate / lag(rate) {OVER} - 1 AS pct, last_value(rate IGNORE NULLS) {SO_FAR}
          / last_value(rate IGNORE NULLS) OVER (PARTITION BY pair ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 AS pct_pad
        FROM {GAPPY_SQL}""",
    {8: "pct pct_pad"},
)
def win_pct_change(t):
    s = gappy(t)
    return add(s, pct=se.pct_change(s), pct_pad=se.pct_change(s, pad=True)).drop("rate")


@query("win_log_return", f"SELECT pair, d, ln(rate / lag(rate) {OVER}) AS r FROM {FX_SQL}", {8: "r"})
def win_log_return(t):
    s = fx(t)
    return add(s, r=se.log_return(s)).drop("rate")


@query("win_diff", f"SELECT pair, d, rate - lag(rate) {OVER} AS diff FROM {FX_SQL}", {7: "diff"})
def win_diff(t):
    s = fx(t)
    return add(s, diff=se.diff(s)).drop("rate")


@query(
    "win_rolling_mean",
    f"SELECT pair, d, {rolled('avg', 'rate', 20)} AS ma20, {rolled('avg', 'rate', 50)} AS ma50 FROM {GAPPY_SQL}",
    {8: "ma20 ma50"},
)
def win_rolling_mean(t):
    s = gappy(t)
    return add(s, ma20=se.rolling(s, 20), ma50=se.rolling(s, 50)).drop("rate")


@query(
    "win_rolling_std",
    f"""SELECT pair, d, {rolled('stddev_samp', 'ret', 21)} * sqrt(252) AS vol FROM {RET_SQL}""",
    {8: "vol"},
)
def win_rolling_std(t):
    s = fx(t)
    r = s.with_columns(ret=se.pct_change(s)).of("ret")
    return add(r, vol=se.rolling_volatility(r, 21)).drop("rate", "ret")


def bands(spread):
    return f"""SELECT pair, d, middle, middle - 2 * spread AS lower, middle + 2 * spread AS upper,
      CASE WHEN rate < middle - 2 * spread THEN 1 WHEN rate > middle + 2 * spread THEN -1 ELSE 0 END::BIGINT AS signal
      FROM (SELECT *, {rolled('avg', 'rate', 20)} AS middle, {spread} AS spread FROM {RET_SQL})"""


@query(
    "win_bollinger",
    f"""SELECT 'price' AS mode, * FROM ({bands(rolled('stddev_samp', 'rate', 20))}) UNION ALL
        SELECT 'annualised', * FROM ({bands(rolled('stddev_samp', 'ret', 20) + ' * sqrt(252)')})""",
    {8: "middle lower upper"},
)
def win_bollinger(t):
    modes = [se.bollinger(fx(t), mode=m).select(F.lit(m).alias("mode"), "*").drop("rate") for m in ("price", "annualised")]
    return modes[0].unionByName(modes[1])


@query(
    "win_rsi",
    f"""WITH s AS (SELECT pair, d, rate - lag(rate) {OVER} AS x FROM {FX_SQL}),
             g AS (SELECT pair, d, greatest(x, 0.0) AS gain, greatest(-x, 0.0) AS loss, x FROM s),
             h AS (SELECT pair, d, CASE WHEN x IS NULL THEN NULL ELSE gain END AS gain, CASE WHEN x IS NULL THEN NULL ELSE loss END AS loss FROM g),
             m AS (SELECT pair, d, {rolled('avg', 'gain', 14)} AS g, {rolled('avg', 'loss', 14)} AS l FROM h)
        SELECT pair, d, CASE WHEN l = 0 AND g > 0 THEN 100.0 ELSE 100 - 100 / (1 + g / l) END AS rsi FROM m""",
    {6: "rsi"},
)
def win_rsi(t):
    return se.rsi(fx(t)).drop("rate")


EWM_SQL = f"""s AS (SELECT pair, d, rate, row_number() {OVER} AS i FROM {FX_SQL}),
  e AS (SELECT pair, d, i, rate AS ema_fast, rate AS ema_slow FROM s WHERE i = 1 UNION ALL
        SELECT s.pair, s.d, s.i, 2.0/13 * s.rate + 11.0/13 * e.ema_fast, 2.0/27 * s.rate + 25.0/27 * e.ema_slow
        FROM e JOIN s ON s.pair = e.pair AND s.i = e.i + 1)"""


@query("win_ewm", f"WITH RECURSIVE {EWM_SQL} SELECT pair, d, ema_fast, ema_slow FROM e", {8: "ema_fast ema_slow"})
def win_ewm(t):
    return se.ewm(fx(t), {"ema_fast": 12, "ema_slow": 26}).drop("rate")


@query(
    "win_macd",
    f"""WITH RECURSIVE {EWM_SQL}, m AS (SELECT pair, d, i, ema_fast - ema_slow AS macd FROM e),
          g AS (SELECT pair, d, i, macd, macd AS signal FROM m WHERE i = 1 UNION ALL
                SELECT m.pair, m.d, m.i, m.macd, 0.2 * m.macd + 0.8 * g.signal FROM g JOIN m ON m.pair = g.pair AND m.i = g.i + 1)
        SELECT pair, d, macd, signal, CASE WHEN macd > signal THEN 'BUY' ELSE 'SELL' END AS state FROM g""",
    {8: "macd signal"},
)
def win_macd(t):
    return se.macd(fx(t)).select("pair", "d", "macd", "signal", "state")


@query(
    "win_crossover",
    f"""WITH m AS (SELECT pair, d, {rolled('avg', 'rate', 20)} AS f, {rolled('avg', 'rate', 50)} AS s FROM {FX_SQL}),
             p AS (SELECT *, lag(f) {OVER} AS pf, lag(s) {OVER} AS ps FROM m)
        SELECT pair, count(*) FILTER (f > s AND pf <= ps) AS buys, count(*) FILTER (f < s AND pf >= ps) AS sells FROM p GROUP BY pair""",
)
def win_crossover(t):
    return se.crossovers(fx(t))


@query(
    "win_drawdown",
    f"""WITH p AS (SELECT pair, d, (rate - max(rate) {SO_FAR}) / max(rate) {SO_FAR} AS dd FROM {FX_SQL})
        SELECT pair, min(dd) AS max_drawdown, max_by(dd, d) AS current_drawdown FROM p GROUP BY pair""",
    {8: "max_drawdown current_drawdown"},
)
def win_drawdown(t):
    return se.drawdown(fx(t))


@query("win_ffill", f"SELECT pair, d, last_value(rate IGNORE NULLS) {SO_FAR} AS rate FROM {GAPPY_SQL}")
def win_ffill(t):
    s = gappy(t)
    return add(s, rate=se.forward_fill(s))


AHEAD = "OVER (PARTITION BY pair ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@query(
    "win_interpolate",
    f"""WITH p AS (SELECT *, row_number() {OVER} AS i FROM {GAPPY_SQL}),
             k AS (SELECT *, CASE WHEN rate IS NOT NULL THEN i END AS ki FROM p),
             n AS (SELECT *, last_value(rate IGNORE NULLS) {SO_FAR} AS a, last_value(ki IGNORE NULLS) {SO_FAR} AS pa,
                          first_value(rate IGNORE NULLS) {AHEAD} AS b, first_value(ki IGNORE NULLS) {AHEAD} AS pb FROM k)
        SELECT pair, d, CASE WHEN rate IS NOT NULL THEN rate WHEN a IS NOT NULL AND b IS NOT NULL
                             THEN a + (b - a) * (i - pa) / (pb - pa) ELSE a END AS filled FROM n""",
    {8: "filled"},
)
def win_interpolate(t):
    return se.interpolate(gappy(t)).drop("rate")


CUST_SQL = "(SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)"


def customer_totals(t):
    return t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "win_cum_share",
    f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY total DESC, o_custkey) AS pos, count(*) OVER () AS n,
                   sum(total) OVER (ORDER BY total DESC, o_custkey ROWS UNBOUNDED PRECEDING) * 100 / sum(total) OVER () AS cum_pct
              FROM {CUST_SQL})
        SELECT *, (SELECT cum_pct FROM r WHERE pos = greatest(1, floor(n * 0.2))) AS top20_pct FROM r""",
    {2: "total", 6: "cum_pct top20_pct"},
)
def win_cum_share(t):
    totals = customer_totals(t)
    top = ranks.share_at_top(totals, "o_custkey", "total").select("pct").scalar()
    return ranks.cumulative_share(totals, "o_custkey", "total").withColumn("top20_pct", top)


def pct_rank(col):
    return f"(rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2) / count(*) OVER ()"


@query("win_rank_pct", f"SELECT p_partkey, {pct_rank('p_retailprice')} AS price_rank FROM part", {8: "price_rank"})
def win_rank_pct(t):
    return ranks.rank_pct(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", "price_rank").drop("p_retailprice")


RISK = {"l_quantity": 0.3, "l_extendedprice": 0.2, "l_discount": 0.2, "l_tax": 0.15, "l_linenumber": 0.15}
RISK_SQL = " + ".join(
    f"{w} * ({'1 - ' if c == 'l_discount' else ''}{pct_rank(c)})" for c, w in RISK.items()
)


@query(
    "win_risk_score",
    f"""WITH s AS (SELECT round({RISK_SQL}, 9) AS score FROM lineitem)
        SELECT CASE WHEN score > 0 AND score <= 0.25 THEN 'Low' WHEN score <= 0.5 THEN 'Medium' WHEN score <= 0.75 THEN 'High'
                    WHEN score <= 1 THEN 'Critical' END AS tier, count(*) AS n, avg(score) AS mean_score FROM s GROUP BY 1""",
    {7: "mean_score"},
)
def win_risk_score(t):
    rows = t.lineitem.select(*RISK)
    scores = ranks.weighted_rank_score(rows, RISK, inverted=["l_discount"]).withColumn("score", F.round("score", 9))
    return scores.groupBy(ranks.score_tier().alias("tier")).agg(
        ag.rows().alias("n"), F.avg("score").alias("mean_score")
    )


@query(
    "win_zscore",
    """WITH z AS (SELECT event_id, (value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events) AS z FROM events)
       SELECT event_id, z, abs(z) > 3 AS far FROM z""",
    {7: "z"},
)
def win_zscore(t):
    return ranks.zscore(t.events.select("event_id", "value"), "value").select(
        "event_id", "z", (F.abs("z") > 3).alias("far")
    )


@query(
    "win_group_zscore",
    """WITH s AS (SELECT o_orderkey, o_totalprice AS x, isodow(o_orderdate) AS k FROM orders),
            z AS (SELECT o_orderkey, x, (x - avg(x) OVER (PARTITION BY k)) / stddev_samp(x) OVER (PARTITION BY k) AS z FROM s),
            q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM s)
       SELECT o_orderkey, z, abs(z) > 1.7 OR x < q1 - 0.4 * (q3 - q1) OR x > q3 + 0.4 * (q3 - q1) AS flagged FROM z, q""",
    {7: "z"},
)
def win_group_zscore(t):
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("x"), F.weekday("o_orderdate").alias("k"))
    fence = ag.iqr_bounds(rows, "x", width=0.4).select(F.struct("lower", "upper")).scalar()
    z = ranks.group_zscore(rows, "k", "x").withColumn("_f", fence)
    flagged = (F.abs("z") > 1.7) | (F.col("x") < F.col("_f.lower")) | (F.col("x") > F.col("_f.upper"))
    return z.select("o_orderkey", "z", flagged.alias("flagged"))


@query(
    "win_cusum",
    f"""WITH RECURSIVE s AS (SELECT day, volume AS x, row_number() OVER (ORDER BY day) AS i FROM {DAILY_SQL}),
             m AS (SELECT avg(x) AS mu, stddev_samp(x) AS sd FROM s),
             c AS (SELECT 1::BIGINT AS i, 0.0::DOUBLE AS p, 0.0::DOUBLE AS q UNION ALL
                   SELECT s.i, greatest(0, c.p + s.x - mu - 0.5 * sd), greatest(0, c.q + mu - s.x - 0.5 * sd)
                   FROM c JOIN s ON s.i = c.i + 1, m)
        SELECT day, p AS cusum_pos, q AS cusum_neg, abs(p - q) > 4 * sd AS breach FROM c JOIN s USING (i), m""",
    {2: "cusum_pos cusum_neg"},
)
def win_cusum(t):
    return se.cusum(daily(t)).drop("series", "volume")


CHANGE_SQL = f"""(WITH r AS (SELECT pair, d, ret, row_number() {OVER} - 1 AS n1, count(*) OVER (PARTITION BY pair) AS n,
                   sum(ret) OVER (PARTITION BY pair ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s1,
                   sum(ret * ret) OVER (PARTITION BY pair ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS q1,
                   sum(ret) OVER (PARTITION BY pair) AS s, sum(ret * ret) OVER (PARTITION BY pair) AS q
              FROM {RET_SQL} WHERE ret IS NOT NULL),
             v AS (SELECT *, s1 / n1 AS m1, (s - s1) / (n - n1) AS m2 FROM r WHERE n1 >= 50 AND n1 < n - 50)
        SELECT pair, d, n1 AS split, abs(m1 - m2) / (sqrt((q1 - n1 * m1 * m1) / (n1 - 1) / n1
                 + (q - q1 - (n - n1) * m2 * m2) / (n - n1 - 1) / (n - n1)) + 1e-12) AS t FROM v)"""


@query("win_changepoint", f"SELECT * FROM {CHANGE_SQL}", {6: "t"})
def win_changepoint(t):
    s = fx(t)
    r = s.with_columns(ret=se.pct_change(s))
    return se.split_scores(se.Series(r.df.filter("ret IS NOT NULL"), s.keys, s.time, "ret"))


@query(
    "win_changepoint_peaks",
    f"""WITH RECURSIVE s AS MATERIALIZED (SELECT * FROM {CHANGE_SQL} WHERE t >= 0.1),
          g(pair, n, best, rest) AS (
            SELECT pair, 0, NULL::BIGINT, list({{'t': t, 'split': split}} ORDER BY t DESC, split) FROM s GROUP BY pair
            UNION ALL
            SELECT pair, n + 1, rest[1].split, list_filter(rest, lambda x: abs(x.split - rest[1].split) >= 50) FROM g WHERE len(rest) > 0 AND n < 8)
        SELECT s.pair, d, split, t FROM s JOIN g ON s.pair = g.pair AND s.split = g.best""",
    {6: "t"},
)
def win_changepoint_peaks(t):
    s = fx(t)
    r = s.with_columns(ret=se.pct_change(s))
    return se.change_points(se.Series(r.df.filter("ret IS NOT NULL"), s.keys, s.time, "ret"), min_t=0.1)


@query(
    "win_backtest",
    f"""WITH m AS (SELECT pair, d, rate, {rolled('avg', 'rate', 50)} AS f, {rolled('avg', 'rate', 200)} AS s FROM {FX_SQL}),
             g AS (SELECT pair, d, rate, CASE WHEN f > s THEN 1.0 ELSE -1.0 END::DOUBLE AS sig FROM m WHERE f IS NOT NULL AND s IS NOT NULL),
             h AS (SELECT *, lag(sig) {OVER} AS held, rate / lag(rate) {OVER} - 1 AS ret FROM g),
             w AS (SELECT pair, d, rate, coalesce(1 + held * ret - abs(sig - held) / 2 * 0.0005, 1.0) AS growth FROM h),
             e AS (SELECT pair, d, rate, growth - 1 AS r, 10000.0 * product(growth) {SO_FAR} AS equity,
                          10000.0 * rate / first_value(rate) {SO_FAR} AS bh FROM w),
             k AS (SELECT *, (max(equity) {SO_FAR} - equity) / max(equity) {SO_FAR} AS dd FROM e)
        SELECT pair, max_by(equity, d) / 10000 - 1 AS total_return, max_by(bh, d) / 10000 - 1 AS buy_hold_return,
               sqrt(252) * avg(r) / (stddev_samp(r) + 1e-12) AS sharpe, max(dd) AS max_drawdown FROM k GROUP BY pair""",
    {7: "total_return buy_hold_return sharpe max_drawdown"},
)
def win_backtest(t):
    s = fx(t)
    return se.backtest_summary(se.backtest(s), s)


@query(
    "win_half_split",
    f"""SELECT pair, d, (row_number() {OVER} - 1) >= floor(count(*) OVER (PARTITION BY pair) / 2) AS late FROM {FX_SQL}""",
)
def win_half_split(t):
    return se.half_split(fx(t)).drop("rate")


@query("win_last_value", f"SELECT pair, max_by(rate, d) AS last FROM {FX_SQL} GROUP BY pair")
def win_last_value(t):
    return se.last_value(fx(t))


@query(
    "win_rank_groups",
    """SELECT p_brand, mean, row_number() OVER (ORDER BY mean DESC, p_brand) AS rank
       FROM (SELECT p_brand, round(avg(p_retailprice) + 0.00000137, 4) AS mean FROM part GROUP BY 1)""",
)
def win_rank_groups(t):
    groups = t.part.groupBy("p_brand").agg(F.round(F.avg("p_retailprice") + 0.00000137, 4).alias("mean"))
    return se.ranked_groups(groups, "mean", ["p_brand"])


@query(
    "win_ecdf",
    "SELECT DISTINCT event_type, value, cume_dist() OVER (PARTITION BY event_type ORDER BY value) AS ecdf FROM events",
    {8: "ecdf"},
)
def win_ecdf(t):
    return ranks.ecdf(t.events, "value", ["event_type"])
