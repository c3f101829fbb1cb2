"""Projections, recodes, null handling and column audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from tabulyte.operators.ordering import melt, quantiles

# Texts that stand for a missing number, and date patterns.
MISSING_TOKENS = r"(?i)^\s*(ND|N/A|NA|NaN|null)\s*$"
ZONED_DATE = "MMM dd HH:mm:ss zzz yyyy"
PLAIN_DATES = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy")


def equals_flag(col: str, value) -> Column:
    return F.coalesce(F.col(col) == F.lit(value), F.lit(False)).cast("int")


def normalised_flag(col: str, value: str) -> Column:
    return F.coalesce(F.lower(F.trim(col)) == value.lower(), F.lit(False)).cast("int")


def map_values(col: str, mapping: Mapping) -> Column:
    """Recode by a literal mapping; values outside it become null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.col(col))


def to_number(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).try_cast("double")


def number_from_tokens(col: str) -> Column:
    """Number from text with missing-value tokens and thousands commas."""
    text = F.when(~F.col(col).rlike(MISSING_TOKENS), F.replace(F.col(col), F.lit(","), F.lit("")))
    return F.trim(text).try_cast("double")


def to_timestamp_or_null(col: str, *formats: str) -> Column:
    tries = [F.try_to_timestamp(F.col(col), F.lit(f)) for f in (formats or PLAIN_DATES)]
    return F.coalesce(*tries)


def zoned_date(col: str) -> Column:
    """`Mon Jun 01 17:37:11 PDT 2009` or a plain date; anything else is null.

    The weekday text is cut off: it adds nothing and Spark cannot parse it.
    """
    bare = F.regexp_replace(F.trim(col), r"^[A-Za-z]{3} ", "")
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit(ZONED_DATE)),
        *[F.try_to_timestamp(F.trim(col), F.lit(f)) for f in PLAIN_DATES],
    )


def drop_nulls(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how=how, subset=list(subset) if subset else None)


def fill_const(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(value, subset=list(subset) if subset else None)


def infinite_to_null(col: str) -> Column:
    c = F.col(col)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the most frequent non-null value per column, smallest on ties."""
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "value"
    )
    counts = long.filter("value IS NOT NULL").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode")
    )
    return best.groupBy().pivot("feature", list(cols)).agg(F.first("mode"))


def column_stat(df: DataFrame, cols: Sequence[str], stat: str) -> DataFrame:
    """One row with the mean, exact median or mode of each column."""
    if stat == "mean":
        return df.agg(*[F.avg(c).alias(c) for c in cols])
    if stat == "mode":
        return modes(df, cols)
    long = quantiles(melt(df, cols), "value", {"median": 0.5}, ["feature"])
    return long.groupBy().pivot("feature", list(cols)).agg(F.first("median"))


def fill_stat(df: DataFrame, cols: Sequence[str], stat: str = "median") -> DataFrame:
    """Replace nulls by a statistic of the column's present values."""
    stats = column_stat(df, cols, stat)
    one = stats.select(F.struct(*cols)).scalar()
    return df.withColumn("_stat", one).withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_stat.{c}").cast(df.schema[c].dataType)) for c in cols}
    ).drop("_stat")


def count_duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct rows, and rows that repeat an earlier one."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicates"),
    )


def null_audit(df: DataFrame) -> DataFrame:
    """Null count and share per column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    long = counts.unpivot(["_rows"], list(df.columns), "feature", "nulls")
    return long.select(
        "feature", "nulls", F.try_divide(F.col("nulls") * 100.0, F.col("_rows")).alias("null_pct")
    )


def drop_mostly_null(df: DataFrame, limit_pct: float = 50.0) -> DataFrame:
    """Drop the columns with more nulls than the limit; reads one result row."""
    bad = [r.feature for r in null_audit(df).filter(F.col("null_pct") > limit_pct).collect()]
    return df.drop(*bad)


def varying_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column, whether it holds more than one distinct non-null value.

    The smallest and largest value settle it, so no distinct set is built.
    """
    spread = df.agg(*[(F.min(c) < F.max(c)).alias(c) for c in cols])
    return spread.select([F.coalesce(F.col(c), F.lit(False)).alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "varies"
    )


def drop_constant(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the constant ones of `cols`; reads one row per column."""
    constant = [r.feature for r in varying_columns(df, cols).filter(~F.col("varies")).collect()]
    return df.drop(*constant)


def cut(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins `(lo, hi]`; outside all of them is null."""
    c = F.col(col) if isinstance(col, str) else col
    branch = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        inside = F.lit(True)
        if lo != float("-inf"):
            inside = inside & (c > lo)
        if hi != float("inf"):
            inside = inside & (c <= hi)
        branch = F.when(inside, F.lit(label)) if branch is None else branch.when(inside, F.lit(label))
    return branch


def cut_order(col: str | Column, edges: Sequence[float]) -> Column:
    """The 0-based number of the bin that `cut` chooses."""
    return cut(col, edges, list(range(len(edges) - 1)))


def round_to(col: str, step: int) -> Column:
    """Nearest multiple of `step`, halves to even."""
    return F.bround(F.col(col) / F.lit(float(step)), 0) * F.lit(float(step))


def finite(df: DataFrame) -> DataFrame:
    """NaN and infinities of every floating column to null, as a scan would."""
    cols = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: infinite_to_null(c) for c in cols})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
