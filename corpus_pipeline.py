"""A training-data pipeline over `documents`: rule out poor texts, cut repeated lines,
keep one of each group of near duplicates, take benchmark passages out, mix sources.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of `documents`, with n_chars following the text.  Further columns pass through
whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulyte.llm.decontaminate import decontaminate
from tabulyte.llm.line_dedup import run_dedup
from tabulyte.llm.mixing import mix
from tabulyte.llm.ngram_join import ngram_components
from tabulyte.llm.quality import quality
from tabulyte.llm.scratch import kept
from tabulyte.session import shipped

#: Near duplicates in the pipeline: words of a shingle and least similarity in percent.
SHINGLE, PERCENT = 5, 80


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def _free(name: str, docs: DataFrame) -> str:
    """The name, or one with underscores after it that no column of `docs` has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _held(docs: DataFrame) -> DataFrame:
    """Whole rows in one column, whatever their columns are called, beside the id, the text
    and a hash of both: what the stages add can clash with nothing."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), F.col("doc_id").alias("id"), "text", F.xxhash64("doc_id", "text").alias("h"))


def _rows(held: DataFrame, docs: DataFrame, *more) -> DataFrame:
    return held.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], *more)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the compression bands keep."""
    report = _free("quality", docs)
    return quality(docs, report=report).filter(f"{report}.kept").drop(report)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; a text that loses all its words goes."""
    report = _free("line_dedup", docs)
    cut = run_dedup(docs, report=report)
    has_word = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _counted(cut.filter((F.col(f"{report}.removed") == 0) | has_word).drop(report))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, ids of null last.  A
    document is an id with a text: of repeated rows one stays, and rows with the same id
    but other texts are documents of their own."""
    held = _held(docs)
    linked = ngram_components(held.select("h", "text"), SHINGLE, PERCENT, id_col="h")
    groups = linked.select(F.col("doc_id").alias("h"), "component_id").distinct()
    ids = held.select("h", "id").distinct()
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "h"))
    stay = kept(ids.join(groups, "h").groupBy("component_id").agg(first.alias("first")).select("first.id", "first.h"), "stay")
    # one shuffle of the texts serves the join and the repeats
    same = (held.h == stay.h) & held.id.eqNullSafe(stay.id)
    return _rows(held.join(stay.hint("merge"), same, "left_semi").dropDuplicates(["h", "id"]), docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are mostly such passages go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return _counted(decontaminate(docs, benchmark))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, numbered by `copy`, which replaces a column
    of that name."""
    taken = mix(docs).groupBy("doc_id", "text_hash").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    taken = kept(taken.filter("copies > 0"), "taken").withColumnRenamed("doc_id", "t_id")
    held = _held(docs).withColumn("own_hash", F.xxhash64("text"))
    out = held.join(taken.hint("merge"), F.col("id").eqNullSafe(F.col("t_id")) & (F.col("own_hash") == F.col("text_hash")))
    if not taken.filter("rows > 1").isEmpty():  # repeated rows share their copies
        out = out.filter("rows = 1").union(out.filter("rows > 1").dropDuplicates(["id", "own_hash"]))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return _rows(out, docs.drop("copy"), copy)


#: Rows of a batch on its way to Python: whole documents, so that a batch is a few MB.
BATCH_ROWS = 1_000


def _ready(stage):
    """The stage, with the package on the executors and batches of few documents."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
        asked = int(spark.conf.get(setting, "10000"))
        spark.conf.set(setting, str(min(asked, BATCH_ROWS) if asked > 0 else BATCH_ROWS))
        return stage(shipped(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_rules", _ready(quality_rules)),
    ("line_dedup", _ready(line_dedup_stage)),
    ("near_duplicates", _ready(near_duplicates)),
    ("decontaminate", _ready(decontaminated)),
    ("mix", _ready(mixed)),
]

#: Compression ratios, line hashes and seeded draws are not SQL's to express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = kept(docs, name)
    return docs
