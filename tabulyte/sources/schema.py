"""Column naming and the roles columns play, read from the schema alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

# Name parts that mark a target column, and texts that mean yes.
TARGET_HINTS = ("bankrupt", "class", "status", "target", "default")
YES_PATTERN = r"(?i)yes|true|1|bankrupt"


def strip_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def find_target(df: DataFrame, hints: Sequence[str] = TARGET_HINTS) -> str:
    for c in df.columns:
        if any(h in c.lower() for h in hints):
            return c
    raise ValueError("no target column found")


def binary_target(df: DataFrame, hints: Sequence[str] = TARGET_HINTS, name: str = "target") -> DataFrame:
    """Replace the target column by 0/1 under a common name."""
    col = find_target(df, hints)
    dtype = df.schema[col].dataType
    if isinstance(dtype, StringType):
        label = F.coalesce(F.col(col).rlike(YES_PATTERN), F.lit(False)).cast("int")
    elif isinstance(dtype, BooleanType):
        label = F.col(col).cast("int")
    else:
        label = F.col(col)
    return df.withColumn(name, label).drop(*([col] if col != name else []))


def roles(df: DataFrame) -> dict[str, list[str]]:
    """Numeric and categorical column names by type."""
    return {
        "numeric": [f.name for f in df.schema if isinstance(f.dataType, NumericType)],
        "categorical": [f.name for f in df.schema if isinstance(f.dataType, (StringType, BooleanType))],
    }


def features(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """All columns but the excluded ones; names that are absent are ignored."""
    return df.drop(*exclude)
