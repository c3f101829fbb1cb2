"""Join-shaped work: alignment by key, calendars, lookups, nearest match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabulyte.functions.dates import spine
from tabulyte.operators.ordering import running


def align(df: DataFrame, key: str, value: str, side: Column) -> DataFrame:
    """Two series summed by key and subtracted, an absent one counting as 0.

    Both sides come from one table, so one grouped pass replaces a full join.
    """
    amount = F.col(value)
    return (
        df.groupBy(key)
        .agg(
            F.sum(F.when(side, amount).otherwise(0.0)).alias("inflow"),
            F.sum(F.when(side, 0.0).otherwise(amount)).alias("outflow"),
        )
        .withColumn("net", F.col("inflow") - F.col("outflow"))
    )


def on_calendar(facts: DataFrame, day: str, fill: dict) -> DataFrame:
    """One row per day between the first and last date, gaps filled."""
    return spine(facts, day, name=day).join(facts, day, "left").na.fill(fill)


def lookup(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Enrich by key; Spark broadcasts the table when its size allows."""
    return df.join(table, key, "left")


def nearest_within(
    treated: DataFrame, control: DataFrame, score: str, id_col: str, caliper: float
) -> DataFrame:
    """For each treated row the control row with the closest score, with
    replacement, if it lies within the caliper; the lower score, then the
    smaller id, wins a tie.

    Controls collapse to one row per distinct score, and the nearest one on each
    side is a running value over the distinct scores, so neither a crowded score
    nor a crowded neighbourhood multiplies rows.
    """
    c = control.select(F.col(score).alias("_s"), F.col(id_col).alias("_id"))
    t = treated.select(F.col(score).alias("_s"), F.lit(None).cast(c.schema["_id"].dataType).alias("_id"))
    distinct = c.unionByName(t).groupBy("_s").agg(F.min("_id").alias("_id"))
    own = F.when(F.col("_id").isNotNull(), F.struct("_s", "_id"))
    both = running(distinct, ["_s"], {"_below": ("max", own)}, ahead={"_above": ("min", own)})
    choice = F.array_min(F.array_compact(F.array(*[
        F.when(F.col(side).isNotNull(), F.struct(
            F.abs(F.col("_s") - F.col(f"{side}._s")).alias("distance"),
            F.col(f"{side}._s").alias("control_score"), F.col(f"{side}._id").alias("control_id"),
        ))
        for side in ("_below", "_above")
    ])))
    best = both.select("_s", choice.alias("m")).filter(F.col("m.distance") <= caliper)
    return treated.join(best, F.col(score) == F.col("_s")).select(
        *[F.col(x) for x in treated.columns], "m.control_id", "m.control_score", "m.distance"
    )


def threshold_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Confusion counts at every threshold 0.01 … 0.99 (`score >= threshold`).

    Each row falls in one of 101 steps, the steps are counted in one pass, and
    the counts at a threshold are sums over the steps at or above it.
    """
    from tabulyte.functions.maths import hundredth_below
    from pyspark.sql import Window as W

    step = F.least(F.greatest(hundredth_below(score), F.lit(0)), F.lit(99)).cast("int")
    hist = df.groupBy(step.alias("step")).agg(
        F.sum(F.col(label).cast("bigint")).alias("p"), F.count(F.lit(1)).alias("n")
    )
    grid = df.sparkSession.range(0, 100).select(F.col("id").cast("int").alias("step"))
    full = grid.join(hist, "step", "left").na.fill(0, ["p", "n"])
    above = W.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy()
    counts = full.select(
        "step",
        F.sum("p").over(above).alias("tp"),
        (F.sum("n").over(above) - F.sum("p").over(above)).alias("fp"),
        F.sum("p").over(everything).alias("_p"),
        F.sum("n").over(everything).alias("_n"),
    ).filter("step > 0")
    return counts.select(
        (F.col("step") / 100.0).alias("threshold"), "tp", "fp",
        (F.col("_p") - F.col("tp")).alias("fn"),
        (F.col("_n") - F.col("_p") - F.col("fp")).alias("tn"),
    )


def rows_at(df: DataFrame, positions: DataFrame, key: str) -> DataFrame:
    return df.join(positions.select(key), key)


def group_pairs(stats: DataFrame, key: str) -> DataFrame:
    """All unordered pairs of groups of a result-sized table of group statistics."""
    a = stats.select([F.col(c).alias(f"{c}_a") for c in stats.columns])
    b = stats.select([F.col(c).alias(f"{c}_b") for c in stats.columns])
    return a.join(b, F.col(f"{key}_a") < F.col(f"{key}_b"))


def union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def except_values(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.distinct().join(b.distinct(), list(a.columns), "left_anti")


def without_tokens(tokens: DataFrame, col: str, stop: Sequence[str]) -> DataFrame:
    """Drop rows whose token is in a fixed word list."""
    return tokens.filter(~F.col(col).isin(list(stop)))
