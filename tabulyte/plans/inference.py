"""Hypothesis tests, Bayesian rates, survival and matching over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.operators import bayes, causal, hypothesis as hy, series as se, survival
from tabulyte.plans.aggregates import NUMERIC, per_feature
from tabulyte.plans.joins_sets import NEAREST_SQL
from tabulyte.plans.registry import query
from tabulyte.plans.tails import chi2_tail, f_tail, kolmogorov_tail, normal_tails, t_tails, with_p
from tabulyte.plans.stand_ins import SCORED_SQL, fx, scored
from tabulyte.plans.windows import RET_SQL


def chi2_sql(source, a, b):
    """Statistic, degrees of freedom, size and Cramér's V from the full grid of cells."""
    return f"""(WITH s AS ({source}), r AS (SELECT {a} AS a, count(*) AS r FROM s GROUP BY 1),
      c AS (SELECT {b} AS b, count(*) AS c FROM s GROUP BY 1), o AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM s GROUP BY ALL),
      k AS (SELECT count(*) AS n FROM s), d AS (SELECT (SELECT count(*) FROM r) AS nr, (SELECT count(*) FROM c) AS nc),
      e AS (SELECT coalesce(o, 0) AS o, r * c / n AS e, n, nr, nc FROM r CROSS JOIN c CROSS JOIN k CROSS JOIN d LEFT JOIN o USING (a, b)),
      q AS (SELECT sum(power(abs(o - e) - CASE WHEN (nr - 1) * (nc - 1) = 1 THEN least(0.5, abs(o - e)) ELSE 0 END, 2) / e) AS chi2,
                   max((nr - 1) * (nc - 1)) AS df, max(n) AS n, max(least(nr, nc)) AS m FROM e)
      SELECT chi2, df, n, sqrt(chi2 / (n * (m - 1))) AS cramers_v FROM q)"""


@query(
    "stat_chi2",
    with_p(f"SELECT chi2, df, n FROM {chi2_sql('SELECT * FROM orders', 'o_orderstatus', 'o_orderpriority')}", chi2_tail("chi2", "df")),
    {6: "chi2", 7: "p_value"},
)
def stat_chi2(t):
    return hy.chi2(t.orders, "o_orderstatus", "o_orderpriority").select("chi2", "df", "n", "p_value")


YATES_SOURCE = "SELECT l_returnflag = ''R'' AS a, l_linestatus AS b FROM lineitem".replace("''", "'")


@query(
    "stat_cramers_v",
    with_p(f"SELECT chi2, df, n, cramers_v FROM {chi2_sql(YATES_SOURCE, 'a', 'b')}", chi2_tail("chi2", "df")),
    {6: "chi2", 9: "cramers_v", 7: "p_value"},
)
def stat_cramers_v(t):
    rows = t.lineitem.select((F.col("l_returnflag") == "R").alias("a"), F.col("l_linestatus").alias("b"))
    return hy.chi2(rows, "a", "b")


@query(
    "stat_rel_risk",
    """SELECT i AS rate_in, o AS rate_out, i / o AS risk_ratio FROM (
         SELECT avg((o_orderstatus = 'F')::INT) FILTER (o_totalprice > 250000) AS i,
                avg((o_orderstatus = 'F')::INT) FILTER (o_totalprice <= 250000) AS o FROM orders)""",
    {8: "rate_in rate_out risk_ratio"},
)
def stat_rel_risk(t):
    return hy.relative_risk(t.orders, F.col("o_totalprice") > 250000, F.col("o_orderstatus") == "F")


def labelled_lines(t):
    return t.lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("int"))


SIDES = """count($) FILTER (y) AS n1, avg($) FILTER (y) AS m1, var_samp($) FILTER (y) AS v1,
           count($) FILTER (NOT y) AS n0, avg($) FILTER (NOT y) AS m0, var_samp($) FILTER (NOT y) AS v0"""
GROUPS_SQL = f"({per_feature(SIDES, table='''(SELECT *, l_returnflag = 'R' AS y FROM lineitem)''')})"


@query(
    "stat_t_pooled",
    with_p(
        f"""SELECT feature, m1 AS mean_1, m0 AS mean_0, n1 + n0 - 2 AS df,
                   (m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2) * (1 / n1 + 1 / n0)) AS t FROM {GROUPS_SQL}""",
        t_tails("t", "df"),
    ),
    {5: "mean_1 mean_0", 6: "t", 7: "p_value"},
)
def stat_t_pooled(t):
    return hy.t_pooled(labelled_lines(t), NUMERIC, "y")


@query(
    "stat_t_welch",
    with_p(
        f"""SELECT feature, m1 AS mean_1, m0 AS mean_0, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) AS t,
                   power(v1 / n1 + v0 / n0, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v0 / n0, 2) / (n0 - 1)) AS df FROM {GROUPS_SQL}""",
        t_tails("t", "df"),
    ),
    {5: "mean_1 mean_0", 6: "t", 3: "df", 7: "p_value"},
)
def stat_t_welch(t):
    return hy.t_welch(labelled_lines(t), NUMERIC, "y")


@query(
    "stat_cohen_d",
    f"""SELECT feature, (m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2)) AS pooled,
               (m1 - m0) / sqrt((v1 + v0) / 2) AS averaged,
               (m1 - m0) / sqrt((v1 * (n1 - 1) / n1 + v0 * (n0 - 1) / n0) / 2) AS population FROM {GROUPS_SQL}""",
    {8: "pooled averaged population"},
)
def stat_cohen_d(t):
    return hy.cohen_d(labelled_lines(t), NUMERIC, "y")


@query(
    "stat_anova",
    with_p(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, (sb / (k - 1)) / (sw / (n - k)) AS f, k - 1 AS df1, (n - k)::BIGINT AS df2 FROM (
                  SELECT sum(g.n * power(g.m - (SELECT avg({c}) FROM lineitem), 2)) AS sb, sum((g.n - 1) * g.v) AS sw, count(*) AS k, sum(g.n) AS n
                  FROM (SELECT l_returnflag, count({c}) AS n, avg({c}) AS m, var_samp({c}) AS v FROM lineitem GROUP BY 1) g)"""
            for c in NUMERIC
        ),
        f_tail("f", "df1", "df2"),
    ),
    {6: "f", 7: "p_value"},
)
def stat_anova(t):
    return hy.anova(t.lineitem, NUMERIC, "l_returnflag")


@query(
    "stat_kruskal",
    with_p(
        """WITH r AS (SELECT l_returnflag AS g, l_quantity AS v, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS r FROM lineitem),
                n AS (SELECT count(*)::DOUBLE AS n FROM r), s AS (SELECT g, count(*) AS k, sum(r) AS sr FROM r GROUP BY g),
                ties AS (SELECT sum(power(c, 3) - c) AS t FROM (SELECT count(*) AS c FROM r GROUP BY v))
           SELECT (12 / (n * (n + 1)) * sum(sr * sr / k) - 3 * (n + 1)) / (1 - t / (power(n, 3) - n)) AS h, count(*) - 1 AS df
           FROM s, n, ties GROUP BY n, t""",
        chi2_tail("h", "df"),
    ),
    {5: "h", 7: "p_value"},
)
def stat_kruskal(t):
    return hy.kruskal(t.lineitem, "l_quantity", "l_returnflag")


def mann_whitney_sql(source):
    """`source` has columns v and y (true for the first sample)."""
    return f"""(WITH s AS ({source}), r AS (SELECT v, y, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2 AS r FROM s),
      a AS (SELECT count(*) FILTER (y)::DOUBLE AS n1, count(*)::DOUBLE AS n, sum(r) FILTER (y) AS r1 FROM r),
      ties AS (SELECT sum(power(c, 3) - c) AS t FROM (SELECT count(*)::DOUBLE AS c FROM r GROUP BY v)),
      u AS (SELECT r1 - n1 * (n1 + 1) / 2 AS u, n1 * (n - n1) AS m, n, t FROM a, ties)
      SELECT u, (greatest(u, m - u) - m / 2 - 0.5) / sqrt(m / 12 * (n + 1 - t / (n * (n - 1)))) AS z FROM u)"""


@query(
    "stat_mannwhitney",
    with_p(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, * FROM " + mann_whitney_sql(f"SELECT {c} AS v, l_returnflag = 'R' AS y FROM lineitem")
            for c in NUMERIC
        ),
        normal_tails("greatest(z, 0)"),
    ),
    {1: "u", 6: "z", 7: "p_value"},
)
def stat_mannwhitney(t):
    return hy.mann_whitney(labelled_lines(t), NUMERIC, "y")


@query(
    "stat_ks2",
    with_p(
        """WITH s AS (SELECT l_extendedprice AS v, l_returnflag = 'R' AS y FROM lineitem),
                n AS (SELECT count(*) FILTER (y) AS n1, count(*) FILTER (NOT y) AS n0 FROM s),
                c AS (SELECT v, sum(count(*) FILTER (y)) OVER (ORDER BY v) AS c1, sum(count(*) FILTER (NOT y)) OVER (ORDER BY v) AS c0 FROM s GROUP BY v)
           SELECT max(abs(c1 / n1 - c0 / n0)) AS ks, n1, n0 FROM c, n GROUP BY n1, n0""",
        kolmogorov_tail("(ks * sqrt(n1 * n0 / (n1 + n0)))"),
    ),
    {8: "ks p_value"},
)
def stat_ks2(t):
    return hy.ks_two_sample(labelled_lines(t), "l_extendedprice", "y")


@query(
    "stat_normaltest",
    """WITH s AS (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON COLUMNS(*) INTO NAME feature VALUE v),
            a AS (SELECT feature, avg(v) AS m FROM s GROUP BY 1),
            c AS (SELECT feature, count(*)::DOUBLE AS n, avg(power(v - m, 2)) AS m2, avg(power(v - m, 3)) AS m3, avg(power(v - m, 4)) AS m4
                  FROM s JOIN a USING (feature) GROUP BY 1),
            g AS (SELECT feature, n, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2,
                         3 * (n*n + 27*n - 70) * (n+1) * (n+3) / ((n-2) * (n+5) * (n+7) * (n+9)) AS beta2,
                         3 * (n-1) / (n+1) AS mu, 24 * n * (n-2) * (n-3) / ((n+1) * (n+1) * (n+3) * (n+5)) AS va,
                         6 * (n*n - 5*n + 2) / ((n+7) * (n+9)) * sqrt(6 * (n+3) * (n+5) / (n * (n-2) * (n-3))) AS rt FROM c),
            h AS (SELECT *, sqrt(2 * (beta2 - 1)) - 1 AS w2, (b2 - mu) / sqrt(va) AS x,
                         6 + 8 / rt * (2 / rt + sqrt(1 + 4 / (rt * rt))) AS a FROM g),
            z AS (SELECT feature, asinh(g1 * sqrt((n+1) * (n+3) / (6 * (n-2))) / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1,
                         (1 - 2 / (9*a) - sign((1 - 2/a) / (1 + x * sqrt(2 / (a-4)))) * power(abs((1 - 2/a) / (1 + x * sqrt(2 / (a-4)))), 1.0/3)) / sqrt(2 / (9*a)) AS z2 FROM h)
       SELECT feature, z1*z1 + z2*z2 AS k2, exp(-(z1*z1 + z2*z2) / 2) AS p_value FROM z""",
    {3: "k2", 8: "p_value"},
)
def stat_normaltest(t):
    return hy.normal_test(t.lineitem, NUMERIC)


@query(
    "stat_jarque_bera",
    f"""WITH m AS (SELECT pair, avg(ret) AS m FROM {RET_SQL} GROUP BY pair),
          c AS (SELECT pair, count(ret) AS n, avg(power(ret - m, 2)) AS m2, avg(power(ret - m, 3)) AS m3, avg(power(ret - m, 4)) AS m4
                FROM {RET_SQL} JOIN m USING (pair) GROUP BY pair),
          j AS (SELECT pair, n / 6 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4) AS jb FROM c)
        SELECT pair, jb, exp(-jb / 2) AS p_value FROM j""",
    {6: "jb", 9: "p_value"},
)
def stat_jarque_bera(t):
    s = fx(t)
    return hy.jarque_bera(s.with_columns(ret=se.pct_change(s)).df, "ret", ["pair"])


@query(
    "stat_f_ratio",
    f"""SELECT pair, a AS var_before, b AS var_after, greatest(a, b) / least(a, b) AS f FROM (
          SELECT pair, var_samp(ret) FILTER (d < DATE '1998-01-01') AS a, var_samp(ret) FILTER (d >= DATE '1998-01-01') AS b
          FROM {RET_SQL} GROUP BY pair)""",
    {10: "var_before var_after", 7: "f"},
)
def stat_f_ratio(t):
    s = fx(t)
    returns = s.with_columns(ret=se.pct_change(s)).df
    return hy.variance_ratio(returns, "ret", F.col("d") >= F.expr("DATE'1998-01-01'"), ["pair"])


@query(
    "stat_benford",
    with_p(
        """WITH d AS (SELECT CAST(regexp_extract(abs(c_acctbal)::VARCHAR, '[1-9]') AS BIGINT) AS digit FROM customer WHERE c_acctbal <> 0),
                o AS (SELECT g.digit, count(d.digit) AS n FROM (SELECT unnest(range(1, 10)) AS digit) g LEFT JOIN d USING (digit) GROUP BY 1),
                e AS (SELECT digit, n, log10(1 + 1 / digit) * sum(n) OVER () AS expected FROM o)
           SELECT digit, n, expected, sum(power(n - expected, 2) / expected) OVER () AS chi2 FROM e""",
        chi2_tail("chi2", "8"),
    ),
    {6: "expected chi2", 7: "p_value"},
)
def stat_benford(t):
    return hy.benford(t.customer, "c_acctbal")


REGIME_SOURCE = f"""SELECT d >= DATE '1998-01-01' AS late, abs(ret) > (SELECT stddev_samp(ret) FROM {RET_SQL}) AS volatile
                    FROM {RET_SQL} WHERE ret IS NOT NULL"""


@query(
    "stat_regime_chi2",
    with_p(f"SELECT chi2, df, n FROM {chi2_sql(REGIME_SOURCE, 'late', 'volatile')}", chi2_tail("chi2", "df")),
    {6: "chi2", 7: "p_value"},
)
def stat_regime_chi2(t):
    s = fx(t)
    returns = s.with_columns(ret=se.pct_change(s)).df
    return hy.regime_chi2(returns, "ret", F.col("d") >= F.expr("DATE'1998-01-01'")).select("chi2", "df", "n", "p_value")


@query(
    "stat_pairwise_t",
    with_p(
        """WITH g AS (SELECT o_orderpriority AS k, count(*) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM orders GROUP BY 1)
           SELECT a.k AS k_a, b.k AS k_b, a.n + b.n - 2 AS df, (a.m - b.m) / sqrt((a.v + b.v) / 2) AS d,
                  (a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1 / a.n + 1 / b.n)) AS t
           FROM g a JOIN g b ON a.k < b.k""",
        t_tails("t", "df"),
    ),
    {7: "t d p_value"},
)
def stat_pairwise_t(t):
    return hy.pairwise_t(t.orders, "o_totalprice", "o_orderpriority")


@query(
    "stat_normal_ci",
    """SELECT l_returnflag, avg(l_extendedprice) AS mean,
              avg(l_extendedprice) - 1.96 * stddev_samp(l_extendedprice) / sqrt(count(*)) AS lower,
              avg(l_extendedprice) + 1.96 * stddev_samp(l_extendedprice) / sqrt(count(*)) AS upper FROM lineitem GROUP BY 1""",
    {4: "mean lower upper"},
)
def stat_normal_ci(t):
    return hy.normal_interval(t.lineitem, "l_extendedprice", ["l_returnflag"])


POSTERIOR_SQL = """SELECT o_orderpriority, k, n, k + 1 AS alpha, n - k + 1 AS beta, (k + 1) / (n + 2) AS mean FROM (
  SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS k, count(*) AS n FROM orders GROUP BY 1)"""


@query("bayes_beta_posterior", POSTERIOR_SQL, {9: "mean"})
def bayes_beta_posterior(t):
    return bayes.beta_posterior(t.orders, F.col("o_orderstatus") == "F", ["o_orderpriority"]).drop("lower", "upper")


@query(
    "bayes_beta_interval",
    """WITH RECURSIVE c AS (SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS k, count(o_orderstatus) AS n FROM orders GROUP BY 1),
         b AS (
           SELECT o_orderpriority, k, n, p, 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi FROM c, (VALUES (0.025::DOUBLE), (0.975::DOUBLE)) v(p)
           UNION ALL
           SELECT o_orderpriority, k, n, p, step + 1, CASE WHEN below < p THEN mid ELSE lo END, CASE WHEN below < p THEN hi ELSE mid END
           FROM (SELECT *, list_sum(list_transform(range(k + 1, n + 2),
                          lambda j: exp(lgamma(n + 2) - lgamma(j + 1) - lgamma(n + 2 - j) + j * ln(mid) + (n + 1 - j) * ln(1 - mid)))) AS below
                 FROM (SELECT *, (lo + hi) / 2 AS mid FROM b WHERE step < 45)))
       SELECT o_orderpriority, k, n, k + 1 AS alpha, n - k + 1 AS beta, (k + 1) / (n + 2) AS mean,
              max(lo) FILTER (p < 0.5) AS lower, max(lo) FILTER (p > 0.5) AS upper
       FROM b WHERE step = 45 GROUP BY ALL""",
    {8: "mean lower upper"},
)
def bayes_beta_interval(t):
    return bayes.beta_posterior(t.orders, F.col("o_orderstatus") == "F", ["o_orderpriority"])


def draws(t):
    return bayes.rate_draws(t.orders, F.col("o_totalprice") > 250000, F.col("o_orderstatus") == "F")


@query("bayes_prob_greater")
def bayes_prob_greater(t):
    return bayes.prob_greater(draws(t))


@query("bayes_rel_risk")
def bayes_rel_risk(t):
    return bayes.relative_risk(draws(t))


@query(
    "bayes_threshold",
    """SELECT cut, nb AS n_below, kb AS k_below, na AS n_above, ka AS k_above, (kb + 1) / (nb + 2) AS rate_below,
              (ka + 1) / (na + 2) AS rate_above, (na + 1) / (n + 2) AS p_above FROM (
         SELECT cut, count(*) FILTER (l_discount < cut) AS nb, count(*) FILTER (l_discount < cut AND l_returnflag = 'R') AS kb,
                count(*) FILTER (l_discount > cut) AS na, count(*) FILTER (l_discount > cut AND l_returnflag = 'R') AS ka, count(*) AS n
         FROM lineitem, (SELECT unnest([0.02, 0.045, 0.08])::DOUBLE AS cut) GROUP BY cut)""",
    {9: "rate_below rate_above p_above"},
)
def bayes_threshold(t):
    return bayes.thresholds(t.lineitem, "l_discount", F.col("l_returnflag") == "R", [0.02, 0.045, 0.08])


@query(
    "bayes_density_grid",
    f"""SELECT o_orderpriority, x, exp((alpha - 1) * ln(x) + (beta - 1) * ln(1 - x) - (lgamma(alpha) + lgamma(beta) - lgamma(alpha + beta))) AS density
        FROM ({POSTERIOR_SQL}), (SELECT i * 0.005 AS x FROM (SELECT unnest(range(1, 200))::DOUBLE AS i))""",
    {6: "x", 5: "density"},
)
def bayes_density_grid(t):
    posterior = bayes.beta_posterior(t.orders, F.col("o_orderstatus") == "F", ["o_orderpriority"])
    return bayes.density_grid(posterior, "o_orderpriority")


# Tenure: days from first to last order; the event is no order in the last 180 days.
LIVES_SQL = """(SELECT o_custkey, c_mktsegment AS grp, c_acctbal AS bal, datediff('day', min(o_orderdate), max(o_orderdate)) AS tenure, count(*) AS n_orders,
   CAST(max(o_orderdate) < (SELECT max(o_orderdate) FROM orders) - INTERVAL 180 DAY AS BIGINT) AS gone
   FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)"""


def lives(t):
    end = t.orders.agg(F.max("o_orderdate")).scalar()
    per = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"), F.count(F.lit(1)).alias("n_orders")
    )
    named = per.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("grp"),
                                       F.col("c_acctbal").alias("bal")), "o_custkey")
    return named.withColumn("_end", end).select(
        "o_custkey", "grp", "bal", F.datediff("b", "a").cast("bigint").alias("tenure"), "n_orders",
        (F.col("b") < F.col("_end") - F.expr("INTERVAL 180 DAY")).cast("bigint").alias("gone"),
    )


@query(
    "surv_kaplan_meier",
    f"""WITH k AS (SELECT grp, tenure, sum(gone)::BIGINT AS events, count(*) AS n FROM {LIVES_SQL} GROUP BY ALL),
             r AS (SELECT *, sum(n) OVER (PARTITION BY grp ORDER BY tenure DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS at_risk FROM k)
        SELECT grp, tenure, at_risk, events, product(1 - events / at_risk) OVER (PARTITION BY grp ORDER BY tenure ROWS UNBOUNDED PRECEDING) AS survival FROM r""",
    {8: "survival"},
)
def surv_kaplan_meier(t):
    return survival.kaplan_meier(lives(t), "tenure", "gone", ["grp"])


@query(
    "surv_logrank",
    with_p(
        f"""WITH k AS (SELECT tenure, sum(gone) AS d, count(*) AS n, sum(gone) FILTER (g) AS d1, count(*) FILTER (g) AS n1
                       FROM (SELECT *, grp IN ('BUILDING', 'MACHINERY') AS g FROM {LIVES_SQL}) GROUP BY 1),
                 r AS (SELECT d, coalesce(d1, 0) AS d1, sum(n) OVER w AS r, sum(n1) OVER w AS r1 FROM k
                       WINDOW w AS (ORDER BY tenure DESC ROWS UNBOUNDED PRECEDING)),
                 s AS (SELECT sum(d1)::BIGINT AS observed, sum(d * r1 / r) AS expected,
                              sum(CASE WHEN r > 1 THEN d * (r1 / r) * (1 - r1 / r) * (r - d) / (r - 1) ELSE 0 END) AS variance FROM r WHERE d > 0)
            SELECT *, power(observed - expected, 2) / variance AS chi2 FROM s""",
        chi2_tail("chi2", "1"),
    ),
    {6: "expected variance chi2", 7: "p_value"},
)
def surv_logrank(t):
    two = lives(t).withColumn("g", F.col("grp").isin("BUILDING", "MACHINERY").cast("int"))
    return survival.logrank(two, "tenure", "gone", "g")


@query("surv_cox")
def surv_cox(t):
    return survival.cox(lives(t), "tenure", "gone", ["bal", "n_orders"])


@query("causal_propensity")
def causal_propensity(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.month("o_orderdate").alias("m"),
                           (F.col("o_orderstatus") == "F").cast("int").alias("treated"))
    return causal.propensity(rows, ["o_totalprice", "m"], "treated").select("o_orderkey", "propensity")


@query(
    "causal_psm",
    with_p(
        f"""WITH pairs AS ({NEAREST_SQL}),
                 v AS (SELECT s.amount AS v, true AS y FROM pairs JOIN {SCORED_SQL} s USING (id) UNION ALL
                       SELECT s.amount, false FROM pairs JOIN {SCORED_SQL} s ON s.id = pairs.control_id)
            SELECT (SELECT count(*) FROM pairs) AS pairs, avg(v) FILTER (y) AS treated_mean, avg(v) FILTER (NOT y) AS control_mean,
                   avg(v) FILTER (y) - avg(v) FILTER (NOT y) AS difference,
                   (SELECT u FROM {mann_whitney_sql('SELECT * FROM v')}) AS u, (SELECT z FROM {mann_whitney_sql('SELECT * FROM v')}) AS z FROM v""",
        normal_tails("greatest(z, 0)"),
    ),
    {6: "treated_mean control_mean difference", 1: "u", 7: "z p_value"},
)
def causal_psm(t):
    return causal.matched_effect(scored(t), "id", "y", "p", "amount")
