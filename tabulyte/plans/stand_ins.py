"""Derived inputs shared by several queries, as DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulyte.operators.series import Series

# Daily rates: one row per (pair, day); whole cents keep the mean exact.
FX_SQL = """(SELECT o_orderpriority AS pair, CAST(o_orderdate AS DATE) AS d,
             (1000000 + CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) // (count(*) * 500)) / 1000000 AS rate
             FROM orders GROUP BY ALL)"""


def fx(t) -> Series:
    df = t.orders.groupBy(F.col("o_orderpriority").alias("pair"), F.to_date("o_orderdate").alias("d")).agg(
        F.expr("(1000000 + sum(cast(round(o_totalprice * 100) AS bigint)) div (count(1) * 500)) / 1000000").alias("rate")
    )
    return Series(df, ("pair",), "d", "rate")


# Rates with gaps: a rate above 1.07 counts as not quoted.
GAPPY_SQL = f"(SELECT pair, d, CASE WHEN rate <= 1.07 THEN rate END AS rate FROM {FX_SQL})"


def gappy(t) -> Series:
    s = fx(t)
    return Series(s.df.withColumn("rate", F.when(F.col("rate") <= 1.07, F.col("rate"))), s.keys, s.time, s.value)


# Daily order volume, one series over every calendar day (gaps are 0).
DAILY_SQL = """(SELECT s.day, coalesce(v.volume, 0.0) AS volume FROM (
    SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders) s
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS volume FROM orders GROUP BY 1) v USING (day))"""


def daily(t) -> Series:
    from tabulyte.operators.joins import on_calendar

    facts = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("volume")
    )
    return Series(on_calendar(facts, "day", {"volume": 0.0}).withColumn("series", F.lit("orders")),
                  ("series",), "day", "volume")


# Orders with a label and a repeatable pseudo-score between 0 and 1.
HASH_SQL = "((o_orderkey % 1000003) * 48271 % 65537)"
SCORED_SQL = f"""(SELECT o_orderkey AS id, o_orderpriority AS grp, o_totalprice AS amount,
    CAST(o_orderstatus = 'F' AS BIGINT) AS y,
    round(0.75 * {HASH_SQL} / 65537 + CASE WHEN o_orderstatus = 'F' THEN 0.2 ELSE 0 END, 4) AS p FROM orders)"""


def order_hash():
    return (F.col("o_orderkey") % 1000003) * 48271 % 65537


def scored(t):
    late = F.col("o_orderstatus") == "F"
    p = F.lit(0.75) * order_hash() / 65537 + F.when(late, 0.2).otherwise(0.0)
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("grp"),
        F.col("o_totalprice").alias("amount"), late.cast("bigint").alias("y"), F.round(p, 4).alias("p"),
    )
