"""Sorts, top-k reports and repeatable samples.

A sample orders the rows by a hash of their id and takes the first ones, so it
does not depend on partitioning and a lost executor recomputes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.operators.ordering import positions


def hashed(ids: Sequence[str], seed: int = 42) -> Column:
    return F.xxhash64(*ids, F.lit(seed))


def sort_by(df: DataFrame, col: str, ascending: bool = True, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(col).asc() if ascending else F.col(col).desc(), *ties)


def sort_abs(df: DataFrame, col: str, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.abs(col).desc(), *ties)


def head(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def both_ends(df: DataFrame, col: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k largest and k smallest rows, each from its own bounded top-k."""
    top = df.orderBy(F.desc(col), *ties).limit(k).withColumn("end", F.lit("top"))
    bottom = df.orderBy(F.asc(col), *ties).limit(k).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows per group with their rank.

    The rank filter lets Spark keep k rows per group before the shuffle, up to its
    own threshold.  The rows of a group are first dealt to as many parts as there are
    shuffle partitions and cut to k in each, so for any k a crowded group reaches one
    task only with k rows of each part.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    w = W.partitionBy(*keys).orderBy(*order)
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        dealt = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
        some = W.partitionBy(*keys, "_part").orderBy(*order)
        df = dealt.withColumn("_rank", F.row_number().over(some)).filter(F.col("_rank") <= k).drop("_part", "_rank")
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def sample_n(df: DataFrame, ids: Sequence[str], n: int, order: Column | None = None) -> DataFrame:
    key = hashed(ids) if order is None else order
    return df.withColumn("_h", key).orderBy("_h", *ids).limit(n).drop("_h")


def sample_balanced(df: DataFrame, ids: Sequence[str], label: str, n: int, order: Column | None = None) -> DataFrame:
    """The first n rows of each class in hash order; exact for classes of any size."""
    key = hashed(ids) if order is None else order
    ranked = positions(df.withColumn("_h", key), ["_h", *ids], [label], name="_pos")
    return ranked.filter(F.col("_pos") <= n).drop("_h", "_pos")


def shuffled(df: DataFrame, ids: Sequence[str], seed: int = 42) -> DataFrame:
    return df.orderBy(hashed(ids, seed), *ids)


def draw(i: Column, n: Column, seed: int = 42) -> Column:
    """A position from 1 to n for draw number i, from a digest that SQL has too."""
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), i.cast("string")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), n) + 1


def bootstrap(df: DataFrame, ids: Sequence[str], size: int | None = None, seed: int = 42) -> DataFrame:
    """Exactly `size` rows (as many as there are, if none is given) drawn with replacement.

    Draw i takes the row at a hashed position of the order of `ids`, so the sample
    does not depend on partitioning.  An empty table gives an empty sample.
    """
    n = df.count()
    draws = df.sparkSession.range(1, (n if size is None else size) + 1 if n else 1)
    times = draws.select(draw(F.col("id"), F.lit(max(n, 1)), seed).alias("_pos")).groupBy("_pos").agg(F.count(F.lit(1)).alias("_times"))
    rows = positions(df, list(ids), name="_pos").join(times, "_pos")
    return rows.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))).drop("_pos", "_times", "_i")
