"""The numbered queries: each applies its operator to its whole table and derives the
digest columns from the operator's real output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabulyte.llm.chat_format import chat_format, learnt_texts, read_back
from tabulyte.llm.decontaminate import matched
from tabulyte.llm.katz import katz_scores
from tabulyte.llm.line_dedup import run_dedup
from tabulyte.llm.mixing import mix
from tabulyte.llm.ngram_join import ngram_components
from tabulyte.llm.oracles import SQL  # noqa: F401
from tabulyte.llm.packing import pack
from tabulyte.llm.pii import pii_spans
from tabulyte.llm.quality import quality
from tabulyte.llm.secrets import secret_spans
from tabulyte.llm.spelling import spelling_groups
from tabulyte.llm.substring_dedup import substring_dedup
from tabulyte.llm.vector_codes import vector_codes
from tabulyte.session import shipped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def wrap(fn):
        QUERIES[name] = lambda spark, folder: fn(shipped(spark), folder)
        return fn

    return wrap


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _digest(text):
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _listed(spans):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query("op1_line_dedup")
def op1(spark, folder):
    out = run_dedup(_table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("line_dedup.lines").cast("long").alias("n_lines"), F.col("line_dedup.removed").cast("long").alias("n_removed"), _digest("text").alias("kept_sha256"))


@query("op2_mixing")
def op2(spark, folder):
    mixed = mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


@query("op3_substring_dedup")
def op3(spark, folder):
    out = substring_dedup(_table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", _digest("kept_text").alias("kept_sha256"))


@query("op4_chat_format")
def op4(spark, folder):
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"))
    out = chat_format(turns.unionByName(extra)).select("conv_id", "formatted", read_back("formatted").alias("turns"), learnt_texts("formatted", "mask").alias("learnt"))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), _digest(listed).alias("turns_sha256"), F.length(learnt).cast("long").alias("loss_chars"),
        _digest(learnt).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


@query("op5_decontaminate")
def op5(spark, folder):
    found = matched(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), _digest(F.array_join("items", ",")).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query("op6_ngram_join")
def op6(spark, folder):
    return ngram_components(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op7_quality")
def op7(spark, folder):
    return quality(_table(spark, folder, "documents"), carry=["doc_id"]).select("doc_id", "quality.*")


@query("op8_pii")
def op8(spark, folder):
    out = pii_spans(_table(spark, folder, "documents"))
    return out.select(
        "doc_id", *[_count("base", k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")], _digest(_listed("base")).alias("base_sha256"), _listed("spans").alias("spans"))


@query("op9_secrets")
def op9(spark, folder):
    out = secret_spans(_table(spark, folder, "documents"))
    return out.select(
        "doc_id", *[_count("base", k).alias(f"n_{k}") for k in ("assign", "access", "hex")], _digest(_listed("base")).alias("base_sha256"), _listed("spans").alias("spans"))


@query("op10_katz")
def op10(spark, folder):
    return katz_scores(_table(spark, folder, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)


@query("op11_packing")
def op11(spark, folder):
    return pack(_table(spark, folder, "documents"))


@query("op12_spelling")
def op12(spark, folder):
    return spelling_groups(_table(spark, folder, "documents"))


@query("op13_vector_codes")
def op13(spark, folder):
    coded, books = vector_codes(_table(spark, folder, "embeddings"), carry=["label"])
    rows = coded.select(
        "vec_id", F.col("label").alias("_label"), F.array_join(F.transform("_code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        F.aggregate("_dist", F.lit(0).cast("long"), lambda a, d: a + d).alias("error"))
    totals = rows.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    return rows.join(totals, F.col("_label").eqNullSafe(F.col("_of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
