"""Nearest neighbours, outlier factors, isolation forest and oversampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.operators import aggregates as ag, isolation, neighbours as nb
from tabulyte.plans.registry import query
from tabulyte.session import written

# Customers in the plane of balance and order volume, both in thousands.
PLANE_SQL = """(SELECT c_custkey AS id, c_mktsegment AS grp, c_acctbal / 1000 AS a, round(total / 100000, 7) AS b FROM customer
   JOIN (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""


def plane(t):
    totals = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    return t.customer.join(totals, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("grp"), (F.col("c_acctbal") / 1000).alias("a"),
        F.round(F.col("total") / 100000, 7).alias("b"),
    )


def near_sql(k):
    return f"""(SELECT id, nb, d FROM (SELECT p.id, q.id AS nb, sqrt(power(p.a - q.a, 2) + power(p.b - q.b, 2)) AS d
        FROM {PLANE_SQL} p JOIN {PLANE_SQL} q ON p.id <> q.id)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, nb) <= {k})"""


@query("join_knn_topk", f"SELECT id, nb, d FROM {near_sql(5)}", {7: "d"})
def join_knn_topk(t):
    return nb.knn_rows(plane(t), "id", ["a", "b"], 5)


# Customers by whole thousands of balance and by nation: many rows in one place.
CROWD_SQL = "(SELECT c_custkey AS id, floor(c_acctbal / 1000) AS a, c_nationkey % 3 AS b FROM customer)"


@query(
    "join_knn_repeated",
    f"""SELECT p.id, q.id AS nb, sqrt(power(p.a - q.a, 2) + power(p.b - q.b, 2)) AS d FROM {CROWD_SQL} p JOIN {CROWD_SQL} q ON p.id <> q.id
        QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY d, nb) <= 40""",
    {7: "d"},
)
def join_knn_repeated(t):
    crowd = t.customer.select(F.col("c_custkey").alias("id"), F.floor(F.col("c_acctbal") / 1000).alias("a"), (F.col("c_nationkey") % 3).alias("b"))
    return nb.knn_rows(crowd, "id", ["a", "b"], 40)


LOF_SQL = f"""(WITH n AS MATERIALIZED (SELECT * FROM {near_sql(25)}), k AS (SELECT id, max(d) AS kdist FROM n GROUP BY 1),
  l AS (SELECT n.id, 1 / (avg(greatest(kdist, d)) + 1e-10) AS lrd FROM n JOIN k ON k.id = n.nb GROUP BY 1)
  SELECT n.id, avg(o.lrd) / max(p.lrd) AS lof FROM n JOIN l o ON o.id = n.nb JOIN l p ON p.id = n.id GROUP BY 1)"""


@query("ml_lof", f"SELECT id, lof, lof > (SELECT quantile_cont(lof, 0.95) FROM {LOF_SQL}) AS outlier FROM {LOF_SQL}", {6: "lof"})
def ml_lof(t):
    factors = nb.local_outlier_factor(plane(t), "id", ["a", "b"], 25)
    scores = written(factors.withColumn("lof", F.round("lof", 10)), "factors")
    return nb.flag_top(scores, "lof", {"outlier": 0.05})


def forest(t):
    return isolation.isolation_scores(plane(t), "id", ["a", "b"])


@query("ml_isolation_forest")
def ml_isolation_forest(t):
    return nb.flag_top(written(forest(t), "scores"), "score", {"outlier_1": 0.01, "outlier_3": 0.03, "outlier_5": 0.05})


@query("ml_anomaly_consensus")
def ml_anomaly_consensus(t):
    """Which rows isolation and local density both find odd, per segment: the top 5% of each."""
    rows = written(plane(t), "plane")
    alone = nb.flag_top(written(isolation.isolation_scores(rows, "id", ["a", "b"]), "isolation"), "score", {"isolated": 0.05})
    sparse = nb.flag_top(written(nb.local_outlier_factor(rows, "id", ["a", "b"], 25), "factors"), "lof", {"sparse": 0.05})
    votes = nb.consensus(alone, sparse, "isolated", "sparse")
    return votes.join(rows.select("id", "grp"), "id").groupBy("grp").agg(
        ag.rows().alias("n"), F.count_if("isolated").alias("isolated"), F.count_if("sparse").alias("sparse"),
        F.count_if(F.col("votes") >= 1).alias("either"), F.count_if(F.col("votes") == 2).alias("both"),
        (F.count_if(F.col("votes") == 2) * 100.0 / ag.rows()).alias("both_pct"),
    )


@query(
    "ml_smote",
    f"""SELECT y, (SELECT max(n) FROM (SELECT count(*) AS n FROM {PLANE_SQL} GROUP BY a < 1)) AS n
        FROM (SELECT DISTINCT (a < 1)::BIGINT AS y FROM {PLANE_SQL})""",
)
def ml_smote(t):
    rows = plane(t).withColumn("y", (F.col("a") < 1).cast("int"))
    return nb.smote(rows, "id", ["a", "b"], "y").groupBy("y").agg(ag.rows().alias("n"))
