"""Session defaults and the shared folder for checkpoints and landed files."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


_SHIPPED: set[str] = set()


def build_session(app: str = "tabulyte", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI, adaptive execution with skew handling; extra settings win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by the cluster.  A temporary one serves only a local master,
    whose tasks all see it; elsewhere a shared folder must be named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tabulyte-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def package_archive(folder: str) -> str:
    """A zip of this package in `folder`, for executors that do not have it."""
    source = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(folder, "tabulyte.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for at, _, names in os.walk(source):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(at, name)
                out.write(full, os.path.join("tabulyte", os.path.relpath(full, source)))
    return path


def shipped(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, once per application.  Those of a local
    master do not see the driver's import path either."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        context.addPyFile(package_archive(tempfile.mkdtemp(prefix="tabulyte-package-")))
    _SHIPPED.add(context.applicationId)
    return spark


def landing_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one written table or file set."""
    return f"{checkpoint_root(spark)}/landed/{label}-{uuid.uuid4().hex}"


def written(df, label: str):
    """Write `df` once to the shared folder and read it back: cuts the lineage
    and survives the loss of executors."""
    path = landing_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(df) -> None:
    """Delete a table that `written` made and that nothing reads any more."""
    files = df.inputFiles()
    if files and "/landed/" in files[0]:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
