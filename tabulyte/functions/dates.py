"""Calendar expressions and calendar tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def parts(c: str) -> dict[str, Column]:
    return {
        "month": F.month(c), "year": F.year(c), "quarter": F.quarter(c),
        "hour": F.hour(c), "week": F.weekofyear(c),
    }


def names(c: str) -> dict[str, Column]:
    return {
        "weekday": F.date_format(c, "EEEE"), "month_name": F.date_format(c, "MMMM"),
        "weekend": F.dayofweek(c).isin(1, 7),
    }


def monday_zero(c: str) -> Column:
    return F.weekday(c)


def week_end(c: str | Column) -> Column:
    """The Sunday that ends the week of a date."""
    return F.date_add(F.date_trunc("week", c).cast("date"), 6)


def spine(df: DataFrame, day: str, step_days: int = 1, name: str = "day") -> DataFrame:
    """One row per calendar step from the first to the last date of a table."""
    ends = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {step_days} DAY"))).alias(name))


def future_spine(df: DataFrame, day: str, days: int = 30, name: str = "day") -> DataFrame:
    """The given number of days after the last date of a table."""
    last = df.agg(F.max(F.to_date(day)).alias("b"))
    return last.select(F.explode(F.sequence(F.date_add("b", 1), F.date_add("b", days))).alias(name))
