"""Bipartite graph tables from a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def vertices(df: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct nodes of both sides; a name on both sides is one node of the left."""
    a = df.select(F.col(left).cast("string").alias("node"), F.lit(0).alias("side"))
    b = df.select(F.col(right).cast("string").alias("node"), F.lit(1).alias("side"))
    return a.unionByName(b).filter("node IS NOT NULL").groupBy("node").agg(F.min("side").alias("side"))


def edges(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.select(F.col(left).alias("src"), F.col(right).alias("dst")).distinct()


def bipartite_summary(df: DataFrame, left: str, right: str) -> DataFrame:
    """Nodes per side and distinct edges."""
    v = vertices(df, left, right).agg(
        F.count_if(F.col("side") == 0).alias("left_nodes"), F.count_if(F.col("side") == 1).alias("right_nodes")
    )
    return v.withColumn("edges", edges(df, left, right).agg(F.count(F.lit(1))).scalar())
