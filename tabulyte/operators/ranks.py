"""Row-level ranks, shares and scores over tables of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabulyte.operators.clean import cut
from tabulyte.operators.ordering import ranked_values, running


def cumulative_share(groups: DataFrame, key: str, value: str) -> DataFrame:
    """Running percentage of the total from the largest group down, with the
    position of the group and the number of groups."""
    ordered = groups.withColumn("_down", -F.col(value))
    run = running(ordered, ["_down", key], {"_run": ("sum", value), "pos": ("sum", F.lit(1))}, totals=True)
    return run.select(
        *groups.columns, "pos", F.col("pos_total").alias("n"),
        (F.col("_run") * 100 / F.col("_run_total")).alias("cum_pct"),
    )


def share_at_top(groups: DataFrame, key: str, value: str, fraction: float = 0.2) -> DataFrame:
    """Percentage of the total held by the top fraction of groups (at least one)."""
    run = cumulative_share(groups, key, value)
    k = F.greatest(F.lit(1), F.floor(F.col("n") * fraction))
    return run.filter(F.col("pos") == k).select(F.col("pos").alias("groups"), F.col("cum_pct").alias("pct"))


def rank_pct(df: DataFrame, col: str, name: str) -> DataFrame:
    """Percentile rank with averaged ties; null where the value is null."""
    return _attach(df, col, _value_ranks(df, col, name))


def _value_ranks(df: DataFrame, col: str, name: str) -> DataFrame:
    return ranked_values(df.select(col), col).select(
        F.col(col).alias("_v"), (F.col("avg_rank") / F.col("cum_total")).alias(name)
    )


def _attach(df: DataFrame, col: str, value_ranks: DataFrame) -> DataFrame:
    return df.join(value_ranks, F.col(col) == F.col("_v"), "left").drop("_v")


def weighted_rank_score(df: DataFrame, weights: Mapping[str, float], inverted: Sequence[str] = ()) -> DataFrame:
    """Weighted sum of percentile ranks; inverted columns count as 1 - rank.

    Every column is ranked from the input itself, on its distinct values.
    """
    out = df
    score: Column | None = None
    for i, (col, weight) in enumerate(weights.items()):
        out = _attach(out, col, _value_ranks(df, col, f"_r{i}"))
        part = (1 - F.col(f"_r{i}") if col in inverted else F.col(f"_r{i}")) * F.lit(float(weight))
        score = part if score is None else score + part
    return out.withColumn("score", score).drop(*[f"_r{i}" for i in range(len(weights))])


TIER_EDGES = (0.0, 0.25, 0.5, 0.75, 1.0)
TIER_LABELS = ("Low", "Medium", "High", "Critical")


def score_tier(score: str = "score") -> Column:
    return cut(score, TIER_EDGES, TIER_LABELS)


def zscore(df: DataFrame, col: str, name: str = "z") -> DataFrame:
    """Distance from the mean in population standard deviations."""
    stats = df.agg(F.struct(F.avg(col).alias("m"), F.stddev_pop(col).alias("s"))).scalar()
    return (
        df.withColumn("_s", stats)
        .withColumn(name, F.try_divide(F.col(col) - F.col("_s.m"), F.col("_s.s")))
        .drop("_s")
    )


def group_zscore(df: DataFrame, key: str, col: str, name: str = "z") -> DataFrame:
    """z within a group; null where the group does not vary.

    Group statistics are aggregated and joined back, so a crowded group is not
    sorted or held by one task.
    """
    stats = df.groupBy(F.col(key).alias("_k")).agg(F.avg(col).alias("_m"), F.stddev_samp(col).alias("_sd"))
    z = F.try_divide(F.col(col) - F.col("_m"), F.col("_sd"))
    return df.join(stats, F.col(key).eqNullSafe(F.col("_k")), "left").withColumn(name, z).drop("_k", "_m", "_sd")


def ecdf(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Share of a class at or below each of its distinct values."""
    return ranked_values(df, col, keys).select(
        *keys, col, (F.col("cum") / F.col("cum_total")).alias("ecdf")
    )
