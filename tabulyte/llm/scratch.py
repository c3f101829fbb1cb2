"""Intermediate tables of multi-step operators.

They go to the folder that `spark.checkpoint.dir` names, so a lost executor costs
at most the step in hand.  While such a table is written, Spark is asked to drop
the step's shuffle files as soon as the step ends."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tabulyte.session import landing_path

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the queries run inside go when each query ends."""
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder once and read it back."""
    spark = df.sparkSession
    path = landing_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def dropped(df: DataFrame) -> None:
    """Delete a table that `kept` wrote and that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
    if path is not None:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
