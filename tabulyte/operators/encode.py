"""Integer codes for category values, and fixed label orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabulyte.operators.ordering import positions


def label_codes(df: DataFrame, col: str) -> DataFrame:
    """`(value, code)`: 0-based code by sorted value, nulls left out."""
    values = df.select(F.col(col).alias("value")).filter("value IS NOT NULL").distinct()
    return positions(values, ["value"]).select("value", (F.col("pos") - 1).alias("code"))


def factorize_codes(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """`(value, code)`: 0-based code by first appearance in the given order."""
    firsts = (
        df.filter(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.min(F.struct(*order)).alias("first"))
    )
    return positions(firsts, ["first"]).select("value", (F.col("pos") - 1).alias("code"))


def encode(df: DataFrame, col: str, codes: DataFrame, name: str) -> DataFrame:
    """Attach the code of each row's value; Spark picks the join by code-table size."""
    table = codes.select(F.col("value").alias("_value"), F.col("code").alias(name))
    return df.join(table, F.col(col) == F.col("_value"), "left").drop("_value")


def in_label_order(groups: DataFrame, col: str, labels: Sequence[str], fill: dict | None = None) -> DataFrame:
    """Result rows in a given label order; labels without a row are kept."""
    spark = groups.sparkSession
    order = spark.range(len(labels)).select(
        F.element_at(F.lit(list(labels)), (F.col("id") + 1).cast("int")).alias(col),
        F.col("id").alias(f"{col}_ord"),
    )
    joined = order.join(groups, col, "left")
    return joined.na.fill(fill) if fill else joined
