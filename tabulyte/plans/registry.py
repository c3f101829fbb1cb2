"""Registered queries: a Spark plan over the given tables and, where SQL can
express it, the same result as SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabulyte.session import shipped

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Attribute access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


    def spread(self, name: str, key: str = "doc_id") -> DataFrame:
        """A table for text work, which costs far more than reading: where its
        files give fewer splits than there are cores, the rows are dealt to all by key."""
        df = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _plain_types(df: DataFrame) -> DataFrame:
    wide = {T.IntegerType: "bigint", T.ShortType: "bigint", T.ByteType: "bigint",
            T.FloatType: "double", T.DecimalType: "double"}
    cast = {
        f.name: F.col(f"`{f.name}`").cast(wide[type(f.dataType)])
        for f in df.schema
        if type(f.dataType) in wide
    }
    return df.withColumns(cast) if cast else df


def _shift(digits: int) -> float:
    return float(f"1.37e-{digits + 2}")


def query(key: str, sql: str | Callable[[], str] | None = None, rounding: Mapping[int, str] | None = None):
    """Register a plan.  `rounding` maps digits to column names and is applied
    to both sides, so that the summation order does not show in the result.

    A mean of prices may lie exactly half-way between two rounded values; a small
    shift on both sides keeps such a tie from falling either way.
    """

    def wrap(fn: Callable[[Tables], DataFrame]):
        digits = {c: d for d, names in (rounding or {}).items() for c in names.split()}

        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = _plain_types(fn(Tables(shipped(spark), folder)))
            if digits:
                df = df.withColumns({
                    c.strip('"'): F.round(F.col(c.strip('"')) + F.lit(_shift(d)), d) + F.lit(0.0)
                    for c, d in digits.items()
                })
            return df

        if key in PLANS:
            raise ValueError(f"{key} is registered twice")
        PLANS[key] = run
        text = sql() if callable(sql) else sql
        if text is not None:
            if digits:
                parts = ", ".join(f"round({c} + {_shift(d)!r}, {d}) + 0.0 AS {c}" for c, d in digits.items())
                SQL[key] = f"SELECT * REPLACE ({parts}) FROM ({text})"
            else:
                SQL[key] = text
        return fn

    return wrap
