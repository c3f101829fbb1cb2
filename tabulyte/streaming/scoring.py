"""Scoring of arriving text with a saved model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tabulyte.operators.text_model import score_text


def score_stream(spark: SparkSession, table: str, schema: StructType, model_path: str, keep: list[str],
                 out: str, checkpoint: str) -> str:
    """Score all files of a table that have arrived and stop; a later call takes the new
    ones.  The table is a folder of part files or one file.

    Scoring keeps no state, so no watermark is needed; the checkpoint makes each
    file count once even when a run is repeated.
    """
    model = PipelineModel.load(model_path)
    folder, _, name = table.rstrip("/").rpartition("/")
    files = spark.read.schema(schema).parquet(table).inputFiles()
    reader = spark.readStream.schema(schema)
    if len(files) == 1 and files[0].endswith(f"/{name}"):  # a file source needs a folder
        texts = reader.option("pathGlobFilter", name).parquet(folder)
    else:
        texts = reader.parquet(table)
    run = (
        score_text(model, texts, keep)
        .writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return out
