"""Metrics, preparation, chart tables and graph over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.functions import maths
from tabulyte.operators import aggregates as ag, charts, graph, metrics as me, prep, series as se
from tabulyte.plans.aggregates import NUMERIC
from tabulyte.plans.joins_sets import SWEEP_SQL
from tabulyte.plans.registry import SQL, query
from tabulyte.plans.stand_ins import DAILY_SQL, HASH_SQL, SCORED_SQL, daily, fx, order_hash, scored
from tabulyte.plans.windows import RET_SQL

CLASSES = ("F", "O", "P")

# Orders with a predicted status: right for six of ten hash steps.
PREDICTED_SQL = f"""(SELECT o_orderkey AS id, o_orderstatus AS y, CASE WHEN {HASH_SQL} % 10 < 6 THEN o_orderstatus
   ELSE ['F', 'O', 'P'][{HASH_SQL} % 3 + 1] END AS pred FROM orders)"""


def predicted(t):
    h = order_hash()
    other = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (h % 3 + 1).cast("int"))
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("y"),
        F.when(h % 10 < 6, F.col("o_orderstatus")).otherwise(other).alias("pred"),
    )


FLAGGED_SQL = f"(SELECT *, (p >= 0.5)::INT AS pred FROM {SCORED_SQL})"


def flagged(t):
    return scored(t).withColumn("pred", (F.col("p") >= 0.5).cast("int"))


@query(
    "met_confusion",
    f"""SELECT y AS actual, pred AS predicted, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY y) AS row_pct
        FROM {PREDICTED_SQL} GROUP BY 1, 2""",
    {6: "row_pct"},
)
def met_confusion(t):
    return me.confusion(predicted(t))


REPORT_SQL = f"""WITH s AS (SELECT y, pred FROM {PREDICTED_SQL}),
  c AS (SELECT k AS name, count(*) FILTER (y = k AND pred = k) AS tp, count(*) FILTER (pred = k) AS p, count(*) FILTER (y = k) AS support
        FROM s, (SELECT unnest(['F', 'O', 'P']) AS k) GROUP BY k),
  m AS (SELECT name, tp / p AS precision, tp / support AS recall, 2 * (tp / p) * (tp / support) / (tp / p + tp / support) AS f1, support, tp FROM c)
  SELECT name, precision, recall, f1, support FROM m UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM m UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT FROM m UNION ALL
  SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support)::BIGINT FROM m"""


@query("met_class_report", REPORT_SQL, {8: "precision recall f1"})
def met_class_report(t):
    return me.class_report(predicted(t))


RATES = """tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(tn / nullif(tn + fp, 0), 0) AS specificity,
  coalesce((tp::DOUBLE * tn - fp::DOUBLE * fn) / nullif(sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0) AS mcc"""


@query(
    "met_binary",
    f"""SELECT grp, {RATES} FROM (SELECT grp, count(*) FILTER (y = 1 AND pred = 1) AS tp, count(*) FILTER (y = 0 AND pred = 1) AS fp,
          count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 0 AND pred = 0) AS tn FROM {FLAGGED_SQL} GROUP BY grp)""",
    {8: "accuracy precision recall f1 specificity mcc"},
)
def met_binary(t):
    return me.binary(flagged(t), keys=["grp"])


def table_sql(keys="", part=""):
    """Distinct scores from the highest down with running and total counts."""
    k = f"{keys}, " if keys else ""
    p = f"PARTITION BY {part}" if part else ""
    return f"""(SELECT {k}p AS score, sum(y)::BIGINT AS n1, count(*) AS n, sum(sum(y)) OVER ({p} ORDER BY p DESC) AS tp,
      sum(count(*)) OVER ({p} ORDER BY p DESC) AS a, sum(sum(y)) OVER ({p}) AS pos, sum(count(*)) OVER ({p}) AS tot
      FROM {SCORED_SQL} GROUP BY {k}p)"""


@query("met_roc_curve", f"SELECT score, (a - tp) / (tot - pos) AS fpr, tp / pos AS tpr FROM {table_sql()}", {8: "fpr tpr"})
def met_roc_curve(t):
    return me.roc_curve(scored(t))


OVR_SCORES = {c: f"p_{c}" for c in CLASSES}


def class_scores(t):
    h = lambda i: ((F.col("o_orderkey") % 1000003) * (48271 + 7 * i)) % 65537
    return t.orders.select("o_orderstatus", *[
        F.round(F.lit(0.75) * h(i) / 65537 + F.when(F.col("o_orderstatus") == c, 0.2).otherwise(0.0), 4).alias(f"p_{c}")
        for i, c in enumerate(CLASSES)
    ])


def auc_sql(source):
    return f"""(SELECT sum((n - n1) * (tp - n1 + n1 / 2)) / max(tp_all * (n_all - tp_all)) AS auc FROM (
      SELECT p, sum(y) AS n1, count(*) AS n, sum(sum(y)) OVER (ORDER BY p DESC) AS tp, sum(sum(y)) OVER () AS tp_all, sum(count(*)) OVER () AS n_all
      FROM ({source}) GROUP BY p))"""


OVR_SQL = " UNION ALL ".join(
    "SELECT auc FROM " + auc_sql(
        f"""SELECT (o_orderstatus = '{c}')::INT AS y, round(0.75 * ((o_orderkey % 1000003) * {48271 + 7 * i} % 65537) / 65537
            + CASE WHEN o_orderstatus = '{c}' THEN 0.2 ELSE 0 END, 4) AS p FROM orders"""
    )
    for i, c in enumerate(CLASSES)
)


@query(
    "met_roc_auc",
    f"SELECT 'binary' AS kind, auc FROM {auc_sql(f'SELECT y, p FROM {SCORED_SQL}')} UNION ALL SELECT 'macro_ovr', avg(auc) FROM ({OVR_SQL})",
    {8: "auc"},
)
def met_roc_auc(t):
    one = me.roc_auc(scored(t)).select(F.lit("binary").alias("kind"), "auc")
    ovr = me.roc_auc_ovr(class_scores(t), "o_orderstatus", OVR_SCORES)
    return one.unionByName(ovr.select(F.lit("macro_ovr").alias("kind"), "auc"))


@query(
    "met_pr_curve",
    f"SELECT score, tp / a AS precision, tp / pos AS recall, pos / tot AS prevalence FROM {table_sql()}",
    {8: "precision recall prevalence"},
)
def met_pr_curve(t):
    return me.pr_curve(scored(t))


@query(
    "met_avg_precision",
    f"SELECT grp, sum(n1 / pos * tp / a) AS average_precision FROM {table_sql('grp', 'grp')} GROUP BY grp",
    {8: "average_precision"},
)
def met_avg_precision(t):
    return me.average_precision(scored(t), keys=["grp"])


@query("met_brier", f"SELECT avg(power(p - y, 2)) AS brier FROM {SCORED_SQL}", {8: "brier"})
def met_brier(t):
    return me.brier(scored(t))


@query(
    "met_calibration",
    f"""SELECT CAST(least(floor(p * 10), 9) AS BIGINT) AS bin, count(*) AS n, avg(p) AS predicted, avg(y) AS observed
        FROM {SCORED_SQL} GROUP BY 1""",
    {8: "predicted observed"},
)
def met_calibration(t):
    return me.calibration(scored(t))


@query(
    "met_threshold_sweep",
    f"""SELECT threshold, accuracy, precision, recall, f1 FROM (SELECT threshold, {RATES} FROM ({SWEEP_SQL}))
        WHERE threshold BETWEEN 0.05 AND 0.95""",
    {8: "accuracy precision recall f1"},
)
def met_threshold_sweep(t):
    return me.threshold_sweep(scored(t))


@query(
    "met_best_f1_threshold",
    f"""SELECT score AS threshold, round(2 * tp / (a + pos), 12) AS f1, tp / a AS precision, tp / pos AS recall
        FROM {table_sql()} ORDER BY f1 DESC, score LIMIT 1""",
    {8: "f1 precision recall"},
)
def met_best_f1_threshold(t):
    return me.best_f1_threshold(scored(t))


def cheapest_sql(cost, lo, hi):
    return f"""WITH c AS (SELECT threshold, ({cost})::DOUBLE AS cost FROM ({SWEEP_SQL}) WHERE threshold BETWEEN {lo} AND {hi})
      SELECT (SELECT threshold FROM c ORDER BY cost, threshold LIMIT 1) AS threshold, min(cost) AS cost,
             max(cost) FILTER (threshold = 0.5) AS default_cost, max(cost) FILTER (threshold = 0.5) - min(cost) AS saving FROM c"""


@query("met_cost_threshold", cheapest_sql("fn * 100000 + fp * 5000", 0.01, 0.99))
def met_cost_threshold(t):
    return me.cost_threshold(scored(t))


@query("met_cost_benefit", cheapest_sql("fn * 50000 + fp * 5000 - tp * 45000", 0.05, 0.95))
def met_cost_benefit(t):
    return me.cost_benefit(scored(t))


# Cost of predicting a column class for a row class.
COSTS = {("O", "O"): 0, ("O", "P"): 1, ("O", "F"): 5, ("P", "O"): 3, ("P", "P"): 0, ("P", "F"): 8,
         ("F", "O"): 10, ("F", "P"): 6, ("F", "F"): 0}
COST_VALUES = ", ".join(f"('{a}', '{p}', {c})" for (a, p), c in COSTS.items())


@query(
    "met_cost_matrix",
    f"""WITH k AS (SELECT y AS actual, sum(c)::DOUBLE AS cost FROM {PREDICTED_SQL} JOIN (VALUES {COST_VALUES}) v(a, q, c) ON y = a AND pred = q GROUP BY 1)
        SELECT * FROM k UNION ALL SELECT 'total', sum(cost) FROM k""",
)
def met_cost_matrix(t):
    return me.cost_matrix(predicted(t), COSTS)


SCALED = ["l_quantity", "l_extendedprice"]


@query(
    "ml_standard_scale",
    "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, "
    + ", ".join(f"({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem) AS {c}" for c in SCALED)
    + " FROM lineitem",
    {6: "l_quantity l_extendedprice"},
)
def ml_standard_scale(t):
    return prep.standard_scale(t.lineitem.select("l_orderkey", "l_linenumber", *SCALED), SCALED)


@query(
    "ml_robust_scale",
    "WITH q AS (SELECT "
    + ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}" for c in SCALED)
    + " FROM lineitem) SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, "
    + ", ".join(f"({c} - q_{c}[2]) / (q_{c}[3] - q_{c}[1]) AS {c}" for c in SCALED)
    + " FROM lineitem, q",
    {6: "l_quantity l_extendedprice"},
)
def ml_robust_scale(t):
    return prep.robust_scale(t.lineitem.select("l_orderkey", "l_linenumber", *SCALED), SCALED)


RANKED_SQL = f"""(SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH_SQL}, o_orderkey) AS r,
                  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)"""


@query("ml_split_stratified", f"SELECT o_orderkey, o_orderstatus, r <= floor(n * 0.2 + 0.5) AS is_test FROM {RANKED_SQL}")
def ml_split_stratified(t):
    return prep.split_stratified(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "o_orderstatus", 0.2, order_hash())


@query("ml_kfold_stratified", f"SELECT o_orderkey, o_orderstatus, (r - 1) % 5 AS fold FROM {RANKED_SQL}")
def ml_kfold_stratified(t):
    return prep.kfold_stratified(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "o_orderstatus", 5, order_hash())


@query(
    "ml_class_weight",
    """SELECT o_orderkey, (count(*) OVER ()) / (3 * count(*) OVER (PARTITION BY o_orderstatus)) AS weight,
              (count(*) FILTER (o_orderstatus <> 'F') OVER ()) / (count(*) FILTER (o_orderstatus = 'F') OVER ()) AS pos_weight FROM orders""",
    {8: "weight pos_weight"},
)
def ml_class_weight(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    ratio = prep.positive_weight(rows.select((F.col("o_orderstatus") == "F").cast("int").alias("y")), "y").scalar()
    return prep.class_weights(rows, "o_orderstatus").withColumn("pos_weight", ratio).drop("o_orderstatus")


@query(
    "ml_select_kbest",
    lambda: f"SELECT * FROM ({SQL['stat_anova']}) ORDER BY f DESC LIMIT 2",
    {6: "f", 7: "p_value"},
)
def ml_select_kbest(t):
    return prep.select_k_best(t.lineitem, NUMERIC, "l_returnflag", 2)


@query(
    "viz_histogram",
    """WITH e AS (SELECT min(value) AS lo, (max(value) - min(value)) / 50 AS w FROM events),
            b AS (SELECT event_type, CAST(least(floor((value - lo) / w), 49) AS BIGINT) AS bin, lo, w, count(*) AS n FROM events, e GROUP BY ALL)
       SELECT event_type, bin, lo + bin * w AS "left", n, n / (sum(n) OVER (PARTITION BY event_type) * w) AS density FROM b""",
    {6: '"left"', 8: "density"},
)
def viz_histogram(t):
    return charts.histogram(t.events, "value", 50, ["event_type"])


BOX_SQL = """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)"""


@query(
    "viz_boxplot",
    f"""{BOX_SQL} SELECT event_type, q1, q2, q3, min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
               max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
               count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers, count(*) AS n
        FROM events JOIN q USING (event_type) GROUP BY ALL""",
    {5: "q1 q2 q3"},
)
def viz_boxplot(t):
    return charts.boxplot(t.events, "value", "event_type")


KDE_SQL = """s AS (SELECT event_type, count(value) AS n, stddev_samp(value) * power(count(value), -0.2) AS h, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
  v AS (SELECT event_type, value, count(*) AS c FROM events GROUP BY ALL),
  x AS (SELECT event_type, i, n, h, lo - 3 * h + i * (hi - lo + 6 * h) / 199 AS x FROM s, range(200) r(i)),
  k AS (SELECT event_type, i, x, sum(c * exp(-power((x - value) / h, 2) / 2)) / (n * h * sqrt(2 * pi())) AS density FROM x JOIN v USING (event_type) GROUP BY event_type, i, x, n, h)"""


@query("viz_kde", f"WITH {KDE_SQL} SELECT * FROM k", {6: "x", 8: "density"})
def viz_kde(t):
    return charts.kde(t.events, "value", "event_type")


@query("viz_violin", f"{BOX_SQL}, {KDE_SQL} SELECT * FROM k JOIN q USING (event_type)", {6: "x", 8: "density", 5: "q1 q2 q3"})
def viz_violin(t):
    return charts.violin(t.events, "value", "event_type")


@query("viz_count", "SELECT event_type, hour(ts) AS h, count(*) AS n FROM events GROUP BY ALL")
def viz_count(t):
    return ag.crosstab(t.events.withColumn("h", F.hour("ts")), "event_type", "h")


@query(
    "viz_normal_fit",
    f"""WITH s AS (SELECT pair, avg(ret) AS m, stddev_samp(ret) AS sd, min(ret) AS lo, max(ret) AS hi FROM {RET_SQL} GROUP BY pair),
             x AS (SELECT pair, i, m, sd, lo + i * (hi - lo) / 199 AS x FROM s, range(200) r(i))
        SELECT pair, i, x, exp(-power((x - m) / sd, 2) / 2) / (sd * sqrt(2 * pi())) AS density FROM x""",
    {8: "x", 6: "density"},
)
def viz_normal_fit(t):
    s = fx(t)
    return charts.normal_fit(s.with_columns(ret=se.pct_change(s)).df, "ret", "pair")


def _horner(x, coefficients):
    text = f"({coefficients[-1]!r})::DOUBLE"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + ({c!r})::DOUBLE)"
    return text


def _ratio(x, head):
    return f"{_horner(x, getattr(maths, head + '_NUM'))} / {_horner(x, getattr(maths, head + '_DEN'))}"


@query(
    "viz_qq",
    f"""WITH r AS (SELECT o_orderpriority, o_orderkey, o_totalprice, count(*) OVER (PARTITION BY o_orderpriority) AS n,
                          row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS i FROM orders),
             p AS (SELECT *, CASE WHEN i = n THEN power(0.5, 1.0 / n) WHEN i = 1 THEN 1 - power(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END AS p FROM r),
             q AS (SELECT *, p - 0.5 AS q, 0.180625 - (p - 0.5) * (p - 0.5) AS c, sqrt(-ln(least(p, 1 - p))) AS t FROM p)
        SELECT o_orderpriority, o_orderkey, o_totalprice, p AS position,
               CASE WHEN abs(q) <= 0.425 THEN q * {_ratio('c', 'CENTRE')}
                    ELSE sign(q) * CASE WHEN t <= 5 THEN {_ratio('(t - 1.6)', 'NEAR')} ELSE {_ratio('(t - 5.0)', 'FAR')} END END AS theoretical FROM q""",
    {8: "position theoretical"},
)
def viz_qq(t):
    return charts.qq(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), "o_totalprice", ["o_orderkey"], ["o_orderpriority"])


@query(
    "viz_heatmap",
    """SELECT month(o_orderdate) AS "row", dayname(o_orderdate) AS "col", avg(o_totalprice) AS value FROM orders GROUP BY ALL""",
    {4: "value"},
)
def viz_heatmap(t):
    return charts.heatmap(t.orders, F.month("o_orderdate"), F.date_format("o_orderdate", "EEEE"), F.avg("o_totalprice"))


@query(
    "viz_anomaly_points",
    f"""SELECT day, volume, abs(volume - (SELECT avg(volume) FROM {DAILY_SQL})) > 2 * (SELECT stddev_pop(volume) FROM {DAILY_SQL}) AS flagged FROM {DAILY_SQL}""",
)
def viz_anomaly_points(t):
    from tabulyte.operators.ranks import zscore

    points = daily(t).df.drop("series")
    far = zscore(points, "volume").filter(F.abs("z") > 2)
    return charts.marked_points(points, far, "day")


@query(
    "viz_roc_multi",
    f"SELECT grp, score, (a - tp) / (tot - pos) AS fpr, tp / pos AS tpr FROM {table_sql('grp', 'grp')}",
    {8: "fpr tpr"},
)
def viz_roc_multi(t):
    return me.roc_curve(scored(t), keys=["grp"])


@query(
    "graph_bipartite",
    """SELECT (SELECT count(DISTINCT l_partkey) FROM lineitem) AS left_nodes, (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS right_nodes,
              count(*) AS edges FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""",
)
def graph_bipartite(t):
    rows = t.lineitem.select(
        F.concat(F.lit("part "), "l_partkey").alias("a"), F.concat(F.lit("supplier "), "l_suppkey").alias("b")
    )
    return graph.bipartite_summary(rows, "a", "b")
