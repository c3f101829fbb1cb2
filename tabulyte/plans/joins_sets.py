"""Joins, sorts, samples and set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.functions import text as tx
from tabulyte.operators import aggregates as ag, joins, sampling
from tabulyte.plans.registry import query
from tabulyte.plans.scalars import CLEAN_SQL
from tabulyte.plans.stand_ins import DAILY_SQL, HASH_SQL, SCORED_SQL, daily, order_hash, scored

FLOW_SQL = """SELECT CAST(o_orderdate AS DATE) AS d,
  sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS inflow,
  sum(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice ELSE 0 END) AS outflow FROM orders GROUP BY 1"""


@query("join_index_align", f"SELECT d, inflow, outflow, inflow - outflow AS net FROM ({FLOW_SQL})", {2: "inflow outflow net"})
def join_index_align(t):
    dated = t.orders.withColumn("d", F.to_date("o_orderdate"))
    return joins.align(dated, "d", "o_totalprice", F.col("o_orderstatus") == "F")


@query("join_date_spine", f"SELECT day, volume FROM {DAILY_SQL}")
def join_date_spine(t):
    return daily(t).df.drop("series")


@query(
    "join_lookup",
    """SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def join_lookup(t):
    nations = t.nation.withColumnRenamed("n_nationkey", "s_nationkey")
    regions = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    named = joins.lookup(joins.lookup(t.supplier, nations, "s_nationkey"), regions, "n_regionkey")
    return named.select("s_suppkey", "s_name", "n_name", "r_name")


NEAREST_SQL = f"""WITH s AS (SELECT id, p, y FROM {SCORED_SQL}),
  c AS (SELECT p, min(id) AS cid FROM s WHERE y = 0 GROUP BY p),
  m AS (SELECT t.id, t.p, b.p AS bp, b.cid AS bid, a.p AS ap, a.cid AS aid FROM (SELECT * FROM s WHERE y = 1) t
        ASOF LEFT JOIN c b ON t.p >= b.p ASOF LEFT JOIN c a ON t.p <= a.p),
  k AS (SELECT *, coalesce(p - bp, 9) <= coalesce(ap - p, 9) AS lower FROM m)
  SELECT id, p, CASE WHEN lower THEN bid ELSE aid END AS control_id, CASE WHEN lower THEN bp ELSE ap END AS control_score,
         CASE WHEN lower THEN p - bp ELSE ap - p END AS distance FROM k
  WHERE CASE WHEN lower THEN p - bp ELSE ap - p END <= 0.05"""


@query("join_nearest_caliper", NEAREST_SQL, {6: "distance"})
def join_nearest_caliper(t):
    s = scored(t)
    return joins.nearest_within(
        s.filter("y = 1").select("id", "p"), s.filter("y = 0").select("id", "p"), "p", "id", 0.05
    )


SWEEP_SQL = f"""SELECT (i + 1) / 100 AS threshold, count(*) FILTER (y = 1 AND p >= (i + 1) / 100) AS tp,
  count(*) FILTER (y = 0 AND p >= (i + 1) / 100) AS fp, count(*) FILTER (y = 1 AND p < (i + 1) / 100) AS fn,
  count(*) FILTER (y = 0 AND p < (i + 1) / 100) AS tn FROM {SCORED_SQL}, range(99) r(i) GROUP BY i"""


@query("join_grid_cross", SWEEP_SQL)
def join_grid_cross(t):
    return joins.threshold_counts(scored(t), "p", "y")


@query(
    "join_row_id",
    "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def join_row_id(t):
    picked = t.labels.filter(F.col("toxic") == 1)
    return joins.rows_at(t.documents.select("doc_id", "lang", "n_chars"), picked, "doc_id")


@query(
    "join_pairs_of_groups",
    """WITH g AS (SELECT o_orderpriority AS k, count(*) AS n, avg(o_totalprice) AS m FROM orders GROUP BY 1)
       SELECT a.k AS k_a, a.n AS n_a, a.m AS m_a, b.k AS k_b, b.n AS n_b, b.m AS m_b FROM g a JOIN g b ON a.k < b.k""",
    {4: "m_a m_b"},
)
def join_pairs_of_groups(t):
    stats = ag.grouped(t.orders, [F.col("o_orderpriority").alias("k")], n=ag.rows(), m=F.avg("o_totalprice"))
    return joins.group_pairs(stats, "k")


@query("sort_asc_desc", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sort_asc_desc(t):
    return sampling.sort_by(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", False, ["c_custkey"])


@query("sort_abs", "SELECT c_custkey, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey")
def sort_abs(t):
    return sampling.sort_abs(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", ["c_custkey"])


@query("topk_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk_head(t):
    return sampling.head(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 10)


@query(
    "topk_nlargest",
    "SELECT event_id, value FROM events WHERE event_type = 'purchase' ORDER BY value DESC, event_id LIMIT 5",
)
def topk_nlargest(t):
    hits = t.events.filter(F.col("event_type") == "purchase").select("event_id", "value")
    return sampling.head(hits, [F.desc("value"), F.col("event_id")], 5)


@query(
    "topk_both_ends",
    """(SELECT c_custkey, c_acctbal, 'top' AS "end" FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20) UNION ALL
       (SELECT c_custkey, c_acctbal, 'bottom' FROM customer ORDER BY c_acctbal, c_custkey LIMIT 20)""",
)
def topk_both_ends(t):
    return sampling.both_ends(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 20, ["c_custkey"])


TOKENS_SQL = f"""(SELECT lang, unnest(string_split({CLEAN_SQL}, ' ')) AS token FROM documents)"""


def clean_tokens(t):
    return t.spread("documents").select("lang", F.explode(tx.words(tx.clean_spaced("text"))).alias("token"))


@query(
    "topk_per_group",
    f"""SELECT lang, token, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank FROM (
          SELECT lang, token, count(*) AS n FROM {TOKENS_SQL} WHERE token <> '' GROUP BY ALL) QUALIFY rank <= 15""",
)
def topk_per_group(t):
    counts = clean_tokens(t).groupBy("lang", "token").agg(ag.rows().alias("n"))
    return sampling.top_per_group(counts, ["lang"], [F.desc("n"), F.col("token")], 15)


@query("sample_n", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {HASH_SQL}, o_orderkey LIMIT 500")
def sample_n(t):
    return sampling.sample_n(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 500, order_hash())


@query(
    "sample_balanced",
    f"""SELECT o_orderkey, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH_SQL}, o_orderkey) <= 2000""",
)
def sample_balanced(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return sampling.sample_balanced(rows, ["o_orderkey"], "o_orderstatus", 2000, order_hash())


@query("sample_shuffle", "SELECT s_suppkey, s_name FROM supplier")
def sample_shuffle(t):
    return sampling.shuffled(t.supplier.select("s_suppkey", "s_name"), ["s_suppkey"])


@query(
    "sample_replace",
    """SELECT o_orderkey, o_totalprice
       FROM (SELECT ('0x' || substr(md5('42:' || i), 1, 15))::BIGINT % (SELECT count(*) FROM orders) + 1 AS pos
             FROM range(1, (SELECT count(*) + 1 FROM orders)) r(i))
       JOIN (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders) USING (pos)""",
)
def sample_replace(t):
    return sampling.bootstrap(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"])


@query(
    "set_union",
    "SELECT c_custkey AS id, c_acctbal AS bal FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier",
)
def set_union(t):
    return joins.union(
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal")),
        t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal")),
    )


@query("set_except", "SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def set_except(t):
    busy = t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("id"))
    return joins.except_values(t.customer.select(F.col("c_custkey").alias("id")), busy)


@query(
    "set_stopword_anti",
    f"""SELECT token, count(*) AS n FROM {TOKENS_SQL}
        WHERE token <> '' AND token NOT IN ('the', 'and', 'of', 'to', 'in', 'is', 'la', 'le', 'de', 'et') GROUP BY token""",
)
def set_stopword_anti(t):
    kept = joins.without_tokens(clean_tokens(t), "token", ["the", "and", "of", "to", "in", "is", "la", "le", "de", "et"])
    return kept.groupBy("token").agg(ag.rows().alias("n"))
