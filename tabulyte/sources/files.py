"""Readers for delimited files, landed tables and free-text reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabulyte.operators.ordering import positions

_QUOTED = r'"(?:[^"]|"")*"'


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    header: bool = True,
    encoding: str = "UTF-8",
    date_format: str = "yyyy-MM-dd",
    null_value: str = "",
) -> DataFrame:
    """CSV with a declared schema; quotes are doubled inside quoted fields."""
    return (
        spark.read.schema(schema)
        .options(header=header, encoding=encoding, dateFormat=date_format, nullValue=null_value,
                 escape='"', mode="FAILFAST")
        .csv(path)
    )


def read_csv_headerless(
    spark: SparkSession, path: str, schema: StructType | str, encoding: str = "ISO-8859-1"
) -> DataFrame:
    return read_csv(spark, path, schema, header=False, encoding=encoding)


def read_csv_skip_long_lines(
    spark: SparkSession, path: str, columns: Sequence[str], encoding: str = "ISO-8859-1", sep: str = ","
) -> DataFrame:
    """Drop lines with more fields than names; shorter ones end in nulls.

    All columns come back as text.  The `DROPMALFORMED` mode is not used: it
    drops short lines too, and its result depends on the columns selected.
    """
    lines = spark.read.option("encoding", encoding).text(path)
    bare = F.regexp_replace("value", _QUOTED, "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1
    schema = StructType([StructField(c, StringType()) for c in columns])
    parsed = F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "),
                        {"sep": sep, "escape": '"', "mode": "PERMISSIVE"})
    return (
        lines.filter((fields <= len(columns)) & (F.trim("value") != ""))
        .select(parsed.alias("r"))
        .select("r.*")
    )


def read_slice(df: DataFrame, order: Sequence[str], skip: int, rows: int) -> DataFrame:
    """Rows `skip+1 … skip+rows` of the table in the given unique order."""
    numbered = positions(df, order, name="_row")
    return numbered.filter((F.col("_row") > skip) & (F.col("_row") <= skip + rows)).drop("_row")


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that exists on its file system."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(hadoop).exists(path):
            return p
    raise FileNotFoundError(f"none of these paths exists: {list(paths)}")


# The labels that reports print before each figure.
SAMPLE_LABELS = (
    "Total Employees|Total sampled Tweets|Total audits|Total Transactions|"
    "Total Companies analyzed|Total Customers|Total Patients"
)
AUC_LABELS = "AUC-ROC|Clinical AUC-ROC|Diagnostic AUC-ROC|Diagnostic AUC|AUC"
AP_LABELS = (
    "Average Precision|Avg Precision|Clinical Avg Precision|Diagnostic Average Precision|AP"
)


def read_report_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per report file: its name, sample count, AUC and average precision
    as printed, or null where the report has no such line."""
    text = spark.read.text(path, wholetext=True).withColumn(
        "report", F.element_at(F.split(F.input_file_name(), "/"), -1)
    )

    def labelled(labels: str, figure: str):
        return F.regexp_extract("value", rf"(?i)(?:{labels}):\s*({figure})", 1)

    def either(labels: str, short: str):
        colon = labelled(labels, r"[\d.]+")
        equals = F.regexp_extract("value", rf"(?i){short}\s*=\s*([\d.]+)", 1)
        found = F.when(colon != "", colon).otherwise(equals)
        return F.round(F.when(found != "", found).try_cast("double"), 3)

    samples = F.replace(labelled(SAMPLE_LABELS, r"[\d,]+"), F.lit(","), F.lit(""))
    return text.select(
        "report",
        F.when(samples != "", samples).try_cast("bigint").alias("samples"),
        either(AUC_LABELS, "AUC").alias("auc"),
        either(AP_LABELS, "AP").alias("avg_precision"),
    )
