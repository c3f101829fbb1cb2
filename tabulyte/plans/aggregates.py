"""Aggregations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.operators import aggregates as ag
from tabulyte.operators.ordering import quantiles
from tabulyte.plans.registry import query

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GAINS = "(SELECT *, c_acctbal - 4500 AS gain FROM customer)"


def per_feature(select: str, table: str = "lineitem", cols=NUMERIC) -> str:
    """The same SELECT for each feature, stacked."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {select.replace('$', c)} FROM {table}" for c in cols
    )


@query("agg_shape", 'SELECT count(*) AS "rows", 11::BIGINT AS "columns" FROM lineitem')
def agg_shape(t):
    return ag.shape(t.lineitem)


@query("agg_date_range", "SELECT min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem")
def agg_date_range(t):
    return ag.date_range(t.lineitem, "l_shipdate")


@query(
    "agg_class_balance",
    """SELECT sum(y)::BIGINT AS positives, (count(*) - sum(y))::BIGINT AS negatives, avg(y) AS rate,
              (count(*) - sum(y)) / sum(y) AS imbalance
       FROM (SELECT CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem)""",
    {8: "rate imbalance"},
)
def agg_class_balance(t):
    return ag.class_balance(t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y")), "y")


@query(
    "agg_segment_ratio",
    """SELECT avg(o_totalprice) FILTER (dayofweek(o_orderdate) IN (0, 6)) AS inside,
              avg(o_totalprice) FILTER (dayofweek(o_orderdate) NOT IN (0, 6)) AS outside,
              avg(o_totalprice) FILTER (dayofweek(o_orderdate) IN (0, 6))
                / avg(o_totalprice) FILTER (dayofweek(o_orderdate) NOT IN (0, 6)) AS ratio FROM orders""",
    {4: "inside outside", 8: "ratio"},
)
def agg_segment_ratio(t):
    return ag.segment_ratio(t.orders, F.dayofweek("o_orderdate").isin(1, 7), "o_totalprice")


@query(
    "agg_value_counts",
    "SELECT p_type, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM part) AS pct FROM part GROUP BY p_type",
    {6: "pct"},
)
def agg_value_counts(t):
    return ag.frequencies(t.part, "p_type")


@query(
    "agg_describe",
    per_feature(
        """count($) AS n, avg($) AS mean, stddev_samp($) AS std, min($) AS min, max($) AS max,
           quantile_cont($, 0.25) AS q1, quantile_cont($, 0.5) AS q2, quantile_cont($, 0.75) AS q3"""
    ),
    {5: "mean std q1 q2 q3"},
)
def agg_describe(t):
    return ag.describe(t.lineitem, NUMERIC)


@query(
    "agg_scalar_summary",
    """SELECT avg(c_acctbal) AS mean, stddev_samp(c_acctbal) AS std, min(c_acctbal) AS min, max(c_acctbal) AS max,
              max(c_acctbal) - min(c_acctbal) AS range, skewness(c_acctbal) AS skew FROM customer""",
    {5: "mean std range", 7: "skew"},
)
def agg_scalar_summary(t):
    return ag.scalar_summary(t.customer, "c_acctbal")


@query(
    "agg_group_named",
    """SELECT o_orderpriority, count(*) AS n, sum(o_totalprice) AS total, avg(o_totalprice) AS mean,
              stddev_samp(o_totalprice) AS std FROM orders GROUP BY 1""",
    {2: "total", 4: "mean std"},
)
def agg_group_named(t):
    return ag.grouped(
        t.orders, ["o_orderpriority"], n=ag.rows(), total=F.sum("o_totalprice"),
        mean=F.avg("o_totalprice"), std=F.stddev_samp("o_totalprice"),
    )


@query(
    "agg_group_expr",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n, sum(value) AS total FROM events GROUP BY 1",
    {2: "total"},
)
def agg_group_expr(t):
    return ag.grouped(t.events, [F.to_date("ts").alias("day")], n=ag.rows(), total=F.sum("value"))


@query(
    "agg_group_rate",
    """SELECT l_linestatus, count(*) AS n, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS rate
       FROM lineitem GROUP BY 1""",
    {8: "rate"},
)
def agg_group_rate(t):
    return ag.group_rate(t.lineitem, ["l_linestatus"], F.col("l_returnflag") == "R")


@query(
    "agg_group_mean",
    "SELECT lang, avg(toxic) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY lang",
    {8: "rate"},
)
def agg_group_mean(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "toxic"), "doc_id")
    return ag.grouped(joined, ["lang"], rate=F.avg("toxic"))


@query(
    "agg_recurring",
    """WITH g AS (SELECT step, CASE WHEN step = 10 THEN round_even(value / 10, 0) * 10 ELSE round_even(value / 50, 0) * 50 END AS amt,
                         event_type, user_id, count(*) AS n
                  FROM events, (SELECT unnest([10, 50]) AS step) GROUP BY ALL),
            s AS (SELECT step, count(*) FILTER (n >= 3) AS recurring_groups,
                         coalesce(sum(n) FILTER (n >= 3), 0)::BIGINT AS recurring_rows, sum(n)::BIGINT AS "rows" FROM g GROUP BY step)
       SELECT step::BIGINT AS step, recurring_groups, recurring_rows, "rows", "rows" - recurring_rows AS onetime_rows
       FROM s ORDER BY recurring_rows = 0, CASE WHEN recurring_rows > 0 THEN step ELSE -step END LIMIT 1""",
)
def agg_recurring(t):
    return ag.recurring(t.events, "value", ["event_type", "user_id"])


@query("agg_crosstab", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def agg_crosstab(t):
    return ag.crosstab(t.orders, "o_orderstatus", "o_orderpriority")


@query(
    "agg_crosstab_norm",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus) AS share
       FROM orders GROUP BY 1, 2""",
    {8: "share"},
)
def agg_crosstab_norm(t):
    return ag.row_share(ag.crosstab(t.orders, "o_orderstatus", "o_orderpriority"), "o_orderstatus")


@query(
    "agg_crosstab_value",
    """SELECT o_orderpriority, o_orderstatus, sum(o_totalprice) AS total,
              sum(o_totalprice) / sum(sum(o_totalprice)) OVER (PARTITION BY o_orderpriority) AS share
       FROM orders GROUP BY 1, 2""",
    {2: "total", 8: "share"},
)
def agg_crosstab_value(t):
    table = ag.crosstab(t.orders, "o_orderpriority", "o_orderstatus", F.col("o_totalprice"))
    return ag.row_share(table, "o_orderpriority", "total")


@query(
    "agg_pivot",
    """SELECT month(o_orderdate) AS m, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS "F",
              avg(o_totalprice) FILTER (o_orderstatus = 'O') AS "O", avg(o_totalprice) FILTER (o_orderstatus = 'P') AS "P"
       FROM orders GROUP BY 1""",
    {4: "F O P"},
)
def agg_pivot(t):
    monthly = t.orders.withColumn("m", F.month("o_orderdate"))
    return ag.pivot(monthly, ["m"], "o_orderstatus", ["F", "O", "P"], F.avg("o_totalprice"))


@query(
    "agg_nunique",
    """SELECT 'l_partkey' AS feature, count(DISTINCT l_partkey) AS n_distinct FROM lineitem UNION ALL
       SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem UNION ALL
       SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem""",
)
def agg_nunique(t):
    return ag.distinct_counts(t.lineitem, ["l_partkey", "l_suppkey", "l_returnflag"])


@query(
    "agg_class_mean_gap",
    per_feature(
        """avg($) FILTER (l_returnflag = 'R') AS mean_1, avg($) FILTER (l_returnflag <> 'R') AS mean_0,
           abs(avg($) FILTER (l_returnflag = 'R') - avg($) FILTER (l_returnflag <> 'R')) AS gap"""
    ),
    {5: "mean_1 mean_0 gap"},
)
def agg_class_mean_gap(t):
    labelled = t.lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return ag.class_mean_gap(labelled, NUMERIC, "y")


@query(
    "agg_corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM lineitem" for a in NUMERIC for b in NUMERIC
    ),
    {8: "r"},
)
def agg_corr_matrix(t):
    return ag.corr_matrix(t.lineitem, NUMERIC)


@query(
    "agg_corr_target",
    per_feature("corr($, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS r"),
    {8: "r"},
)
def agg_corr_target(t):
    labelled = t.lineitem.withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    return ag.corr_target(labelled, NUMERIC, "y")


@query(
    "agg_corr_lower",
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS r FROM lineitem"
        for i, a in enumerate(NUMERIC) for b in NUMERIC[:i]
    ),
    {8: "r"},
)
def agg_corr_lower(t):
    return ag.corr_matrix(t.lineitem, NUMERIC, lower=True)


@query(
    "agg_moments",
    "SELECT event_type, skewness(value) AS skew, kurtosis(value) AS kurtosis FROM events GROUP BY 1",
    {6: "skew kurtosis"},
)
def agg_moments(t):
    return ag.moments(t.events, "value", ["event_type"])


@query(
    "agg_argmax",
    """WITH g AS (SELECT o_custkey AS k, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1)
       SELECT (SELECT k FROM g ORDER BY v DESC, k LIMIT 1) AS top, (SELECT max(v) FROM g) AS top_value,
              (SELECT k FROM g ORDER BY v, k LIMIT 1) AS bottom, (SELECT min(v) FROM g) AS bottom_value""",
)
def agg_argmax(t):
    return ag.argmax(t.orders, "o_custkey", F.round(F.sum("o_totalprice"), 2))


@query(
    "agg_top_variance",
    f"SELECT * FROM ({per_feature('var_samp($) AS variance')}) ORDER BY variance DESC LIMIT 2",
    {3: "variance"},
)
def agg_top_variance(t):
    return ag.top_variance(t.lineitem, NUMERIC, 2)


@query(
    "agg_iqr_bounds",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
            f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
       SELECT event_type, q1, q3, lower, upper, count(*) AS n,
              count(*) FILTER (value < lower OR value > upper) AS outliers,
              count(*) FILTER (value < lower OR value > upper) * 100.0 / count(*) AS outlier_pct
       FROM events JOIN f USING (event_type) GROUP BY ALL""",
    {5: "q1 q3 lower upper outlier_pct"},
)
def agg_iqr_bounds(t):
    return ag.iqr_bounds(t.events, "value", ["event_type"])


@query(
    "agg_quantile",
    """SELECT quantile_cont(o_totalprice, 0.025) AS p025, quantile_cont(o_totalprice, 0.5) AS p500,
              quantile_cont(o_totalprice, 0.975) AS p975 FROM orders""",
    {4: "p025 p500 p975"},
)
def agg_quantile(t):
    return quantiles(t.orders, "o_totalprice", {"p025": 0.025, "p500": 0.5, "p975": 0.975})


@query(
    "agg_share",
    """SELECT o_orderpriority, sum(o_totalprice) AS total,
              sum(o_totalprice) * 100 / (SELECT sum(o_totalprice) FROM orders) AS pct,
              (SELECT sum(s) FROM (SELECT sum(o_totalprice) AS s FROM orders GROUP BY o_orderpriority ORDER BY s DESC LIMIT 2))
                * 100 / (SELECT sum(o_totalprice) FROM orders) AS top2_pct
       FROM orders GROUP BY 1""",
    {2: "total", 7: "pct top2_pct"},
)
def agg_share(t):
    top2 = ag.top_share(t.orders, "o_orderpriority", "o_totalprice", 2).scalar()
    return ag.shares(t.orders, "o_orderpriority", "o_totalprice").withColumn("top2_pct", top2)


@query(
    "agg_hit_rate",
    f"""SELECT count(*) FILTER (abs(gain) > (SELECT stddev_samp(gain) FROM {GAINS})) AS volatile,
               count(*) FILTER (gain > 0) AS positive, count(*) FILTER (gain < 0) AS negative,
               avg(CASE WHEN gain > 0 THEN 1.0 ELSE 0.0 END) AS positive_rate FROM {GAINS}""",
    {8: "positive_rate"},
)
def agg_hit_rate(t):
    return ag.hit_rates(t.customer.select((F.col("c_acctbal") - 4500).alias("gain")), "gain")


@query(
    "agg_flag_prevalence",
    """SELECT 'urgent' AS flag, avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 100.0 ELSE 0 END) AS pct FROM orders UNION ALL
       SELECT 'large', avg(CASE WHEN o_totalprice > 300000 THEN 100.0 ELSE 0 END) FROM orders""",
    {6: "pct"},
)
def agg_flag_prevalence(t):
    return ag.flag_prevalence(
        t.orders, {"urgent": F.col("o_orderpriority") == "1-URGENT", "large": F.col("o_totalprice") > 300000}
    )


@query(
    "agg_flagged_breakdown",
    """SELECT 'priority' AS breakdown, o_orderpriority AS item, count(*) AS n, sum(o_totalprice) AS total,
              avg(o_totalprice) AS mean, max(o_totalprice) AS max FROM orders WHERE o_totalprice > 450000 GROUP BY 2
       UNION ALL
       SELECT 'day', strftime(o_orderdate, '%Y-%m-%d'), count(*), sum(o_totalprice), avg(o_totalprice), max(o_totalprice)
       FROM orders WHERE o_totalprice > 450000 GROUP BY 2""",
    {2: "total", 4: "mean"},
)
def agg_flagged_breakdown(t):
    flag = F.col("o_totalprice") > 450000
    by = lambda name, key: ag.flagged_breakdown(t.orders, flag, [key.alias("item")], "o_totalprice").select(
        F.lit(name).alias("breakdown"), "*"
    )
    return by("priority", F.col("o_orderpriority")).unionByName(
        by("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
