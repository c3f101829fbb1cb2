"""Line deduplication by content-defined chunks of lines, in Spark expressions only.

A rolling (cyclic) hash over the hashes of each line with words and the one before it
says whether a chunk may end there; as it sees only these two lines, inserted or changed
lines move boundaries only near themselves.  From every line a chunk runs forward to the
first boundary, and one backward, of two lines with words at least and three at most: a
passage is so cut into the same chunks wherever it stands, and its ends are as well
covered as its middle.  Chunks that occur again anywhere are compared by their bytes and
stay once.

Every later occurrence of a run of three or more lines with words goes whole; of two
lines, where the hash sets a boundary at the second (three of four).  Blank lines and
single lines between others never make a chunk of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabulyte.llm.scratch import dropped, kept

#: A boundary stands where these bits of the rolling hash are not all zero.
MASK = 0b11
WORD = r"[^\x20\x09-\x0D]"


def _turned(value: Column, bits: int) -> Column:
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def _with_chunks(df: DataFrame) -> DataFrame:
    """A row per chunk of each text: `first` and `last` line, and `key`, a hash of the lines."""
    marks = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("line"), F.xxhash64(x).alias("hash"), x.rlike(WORD).alias("word")))
    df = df.withColumn("_marks", marks).withColumn("_worded", F.filter("_marks", lambda m: m["word"])).filter(F.size("_worded") > 1)
    n = F.size("_worded") - 1
    rolling = lambda a, b: _turned(a["hash"], 1).bitwiseXOR(b["hash"])
    boundary = F.zip_with(F.slice("_worded", 1, n), F.slice("_worded", 2, n), lambda a, b: rolling(a, b).bitwiseAND(F.lit(MASK).cast("long")) != 0)
    df = df.withColumn("_ends", boundary)
    steps, ends = F.sequence(F.lit(0), n - 1), lambda t: F.get("_ends", t)
    forward = F.transform(steps, lambda t: F.struct(t.alias("a"), F.when(ends(t) | (t + 2 > n), t + 1).otherwise(t + 2).alias("b")))
    backward = F.transform(steps, lambda t: F.struct(F.when(ends(t) | (t == 0), t).otherwise(t - 1).alias("a"), (t + 1).alias("b")))
    df = df.withColumn("_span", F.explode(F.array_distinct(F.concat(forward, backward))))
    df = df.withColumns({"first": F.get("_worded", F.col("_span.a"))["line"], "last": F.get("_worded", F.col("_span.b"))["line"]})
    key = F.xxhash64(F.transform(F.slice("_marks", F.col("first") + 1, F.col("last") - F.col("first") + 1), lambda m: m["hash"]))
    return df.withColumn("key", key).drop("_marks", "_worded", "_ends", "_span", "text")


def run_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", report: str = "line_dedup") -> DataFrame:
    """The input's columns with the text replaced, and `report`, a struct of lines (in the
    input) and removed.

    Of equal chunks the one with the smallest (id, first line, text hash) stays; the lines
    of all others go, except a chunk that shares a line with the one that stays.  The first
    occurrence of every line stays.  Kept lines are joined by line feeds.  A null text stays
    null with 0 lines; an empty text is one line.  Rows with the same id and text are one
    document: they keep the same lines.  Other columns pass through whatever their names;
    one named like `report` is replaced."""
    names = [c for c in docs.columns if c != report]
    base = docs.select(
        F.struct(F.lit(None).alias(report), *[F.col(f"`{c}`") for c in names if c != text_col]).alias("row"),
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(text_col)).alias("text_hash"))
    key_columns = ["id", "text_hash"]
    wide = _with_chunks(base.select(*key_columns, "text"))
    again = kept(wide.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "repeated")
    marked = wide.join(again, "key", "left_semi").groupBy(*key_columns).agg(F.collect_set(F.struct("first", "last", "key")).alias("chunks"))
    marked = marked.select(F.col("id").alias("m_id"), F.col("text_hash").alias("m_hash"), "chunks")
    # what is joined to all texts grows with them: always by sorting, never by broadcast
    found = base.select(*key_columns, "text").join(marked.hint("merge"), F.col("id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")))
    body = lambda c: F.array_join(F.slice("lines", c["first"] + 1, c["last"] - c["first"] + 1), "\n")
    found = found.withColumn("lines", F.split("text", "\n", -1)).select(*key_columns, F.explode(F.transform("chunks", lambda c: F.struct(c["first"], c["last"], c["key"], body(c).alias("body")))).alias("c"))
    found = kept(found.select(*key_columns, "c.*").distinct(), "chunks")
    dropped(again)
    # bytes are compared in the sums: chunks of one hash are one text if the least is the greatest
    same_hash = found.groupBy("key").agg(F.count("*").alias("n"), F.min("body").alias("least"), F.max("body").alias("greatest"), F.min(F.struct("id", "first", "text_hash", "last")).alias("keep"))
    alike = kept(same_hash.filter("n > 1").select("key", (F.col("least") == F.col("greatest")).alias("equal"), "keep"), "alike")
    # a table of its own on this side, so that Spark divides a hot key on the other
    gone = found.drop("body").join(alike.filter("equal").select("key", "keep"), "key")
    mixed = alike.filter("not equal").select("key")
    if not mixed.isEmpty():
        apart = found.join(mixed, "key", "left_semi")
        keep = apart.groupBy("key", "body").agg(F.min(F.struct("id", "first", "text_hash", "last")).alias("keep"))
        gone = gone.unionByName(apart.join(keep, ["key", "body"]).drop("body"))
    same = F.col("id").eqNullSafe(F.col("keep.id")) & (F.col("text_hash") == F.col("keep.text_hash"))
    gone = gone.filter(~(same & (F.col("first") <= F.col("keep.last"))))
    gone = gone.groupBy(*key_columns).agg(F.collect_set(F.struct("first", "last")).alias("gone")).select(F.col("id").alias("g_id"), F.col("text_hash").alias("g_hash"), "gone")
    gone = kept(gone, "removed")
    dropped(found)
    out = base.join(gone.hint("merge"), F.col("id").eqNullSafe(F.col("g_id")) & (F.col("text_hash") == F.col("g_hash")), "left")
    out = out.withColumn("lines", F.split("text", "\n", -1))
    lines = F.coalesce(F.size("lines"), F.lit(0))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.flatten(F.transform("gone", lambda g: F.sequence(g["first"], g["last"]))))
    left = F.transform(stay, lambda i: F.get("lines", i))
    cut = F.col("gone").isNotNull()
    text = F.when(cut, F.array_join(left, "\n")).otherwise(F.col("text"))
    removed = F.when(cut, lines - F.size(stay)).otherwise(0)
    counts = F.struct(F.when(F.col("text").isNull(), 0).otherwise(lines).alias("lines"), removed.alias("removed"))
    # a generator of one row: a later filter on the text must not pull its expression into
    # every lambda that reads it
    out = out.select("row", F.explode(F.array(F.struct(text.alias("text"), counts.alias("counts")))).alias("out"))
    return out.select(*[F.col("out.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names], F.col("out.counts").alias(report))
