"""Text reports and result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def report_lines(df: DataFrame, fmt: str, *cols: str | Column, order: str | None = None) -> DataFrame:
    """One formatted text line per result row."""
    lines = df.orderBy(order) if order else df
    return lines.select(F.format_string(fmt, *cols).alias("value"))


def write_text_report(lines: DataFrame, path: str) -> str:
    """Write a result-sized report as one text file, in the order given."""
    lines.coalesce(1).write.text(path)
    return path


def write_result_table(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path
