"""Mixing sources to target weights by capped water-filling.

Weights share a total; a source whose share exceeds `max_epochs` times its size is
clamped there, and the excess goes to the others by weight until none is above.  A
source is then taken in whole repetitions, and for the rest by a seeded order of its
documents up to the target, again and again over those left that still fit; up to two
more documents close most of what is left."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.llm.scratch import kept

#: Hash buckets of a source; the last one taken is cut by an order of its own rows.
BUCKETS = 4_096
#: Documents added at the end to come nearer to a source's target.
GAP_ROUNDS = 2
WEIGHTS = (5.0, 2.0, 1.0)
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, max_epochs: float) -> list[float]:
    """Targets that share `total` by weight, none above `max_epochs` times its size.

    Sources fill up in the order of cap by weight; where the caps together are below
    `total`, all are at their caps."""
    targets = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (max_epochs * sizes[i] / weights[i], i))
    left, weight = float(total), float(sum(weights))
    for done, i in enumerate(order):
        cap = max_epochs * sizes[i]
        if left * weights[i] <= cap * weight:
            for j in order[done:]:
                targets[j] = left * weights[j] / weight
            break
        targets[i] = float(cap)
        left -= cap
        weight -= weights[i]
    return targets


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = 3, share: float = 1.0, seed: int = 42,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, text_hash, size, source_size, target and
    copies, how often the mix takes it (0 to `max_epochs`).

    size counts words (null or empty text: 0).  Sources are ordered by code point, null
    last, and weigh `weights`, repeating; together they take `share` of all words.  A
    source of size 0 has target 0 and its documents are taken 0 times.  Documents of a
    source take floor(target / source size) copies, and one more in the order of a seeded
    hash as long as the sum stays within the target; documents larger than what is left are
    set aside and the rest is filled again until no free document fits; then, twice, the
    document that brings the sum nearest the target is added where one does.  The hash covers id and text, so reruns agree and copies of
    a row are interchangeable.  Columns other than the three named ones are ignored.

    The driver holds one row per source, which is a configuration-sized list; everything
    per document stays distributed."""
    spark = docs.sparkSession
    sized = kept(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            F.xxhash64(F.col(text_col)).alias("text_hash"), word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("draw"),
        ), "sized")
    sums = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    sums.sort(key=lambda r: (r.source is None, r.source.encode("utf-8") if isinstance(r.source, str) else r.source))
    weight = [float(weights[i % len(weights)]) for i in range(len(sums))]
    targets = water_fill([r.n for r in sums], weight, share * sum(r.n for r in sums), max_epochs)
    plan = [(r.source, r.n, t, int(t // r.n) if r.n else 0) for r, t in zip(sums, targets)]
    kind = sized.schema["source"].dataType.simpleString()
    rest = {p[0]: p[2] - p[3] * p[1] for p in plan}
    plan = spark.createDataFrame(plan, f"source {kind}, source_size long, target double, whole int").withColumnRenamed("source", "s")
    columns = ["doc_id", "source", "text_hash", "size", "source_size", "target", "draw", "whole", "copies"]
    # sources of size 0 have whole 0
    open_ = sized.join(plan, sized.source.eqNullSafe(plan.s)).withColumn("copies", F.col("whole")).select(*columns)
    done, halved = [], False
    least = {r.source: r.n for r in sized.filter("size > 0").groupBy("source").agg(F.min("size").alias("n")).collect()}
    while limits := {s: _limit(rest[s], n, halved) for s, n in least.items() if n is not None and n <= rest[s]}:
        given = spark.createDataFrame([(s, float(rest[s]), float(x)) for s, x in limits.items()], f"s {kind}, rest double, most double")
        marked = kept(_filled(open_, given), "filled")
        for r in marked.groupBy("source").agg(
                F.sum(F.when(F.col("copies") > F.col("whole"), F.col("size"))).alias("taken"),
                F.min(F.when((F.col("copies") == F.col("whole")) & (F.col("size") > 0), F.col("size"))).alias("least")).collect():
            rest[r.source] -= r.taken or 0
            least[r.source] = r.least
        # the next round reads only what is free
        free = (F.col("copies") == F.col("whole")) & (F.col("size") > 0)
        done.append(marked.filter(~free))
        open_ = marked.filter(free)
        halved = not halved
    chosen = open_
    for part in done:
        chosen = chosen.unionByName(part)
    chosen = chosen.select(*columns[:6], F.col("copies").cast("int").alias("copies"))
    for _ in range(GAP_ROUNDS):
        chosen = _nearer(kept(chosen, "chosen"))
    return chosen


def _limit(rest: float, least: int, halved: bool) -> float:
    """The largest size that a round may take.  Every other round leaves documents above half
    of the rest aside: it stops at one of at most that size, or takes all of them, and then at
    most one more fits.  So the rounds grow with the logarithm of the rest."""
    return rest / 2 if halved and least <= rest / 2 else rest


def _filled(free: DataFrame, given: DataFrame) -> DataFrame:
    """One more copy of the documents of size at most `most`, in seeded order up to `rest`."""
    columns = free.columns
    spot = F.pmod(F.col("draw"), F.lit(BUCKETS)).cast("int")
    rows = free.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("s")), "left").withColumn("spot", spot)
    fit = (F.col("size") > 0) & (F.col("size") <= F.col("most"))
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    # the bucket in which the running size of a source passes the rest of its target
    sums = rows.filter("fit").groupBy("source", "rest", "spot").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(W.partitionBy("source").orderBy("spot").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.withColumn("before", F.coalesce(before, F.lit(0))).filter("before <= rest")
    cut = sums.groupBy(F.col("source").alias("c")).agg(F.max("spot").alias("last"), F.max("before").alias("before"))
    rows = rows.join(F.broadcast(cut), F.col("source").eqNullSafe(F.col("c")), "left")
    at_edge = F.col("fit") & (F.col("spot") == F.col("last"))
    sure = rows.filter(~F.coalesce(at_edge, F.lit(False)))
    more = F.when(F.col("fit") & (F.col("spot") < F.col("last")), 1).otherwise(0)
    sure = sure.withColumn("copies", F.col("copies") + more).select(*columns)
    order = W.partitionBy("source").orderBy("draw", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    edge = rows.filter(at_edge).withColumn("below", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    more = F.when(F.col("below") + F.col("size") <= F.col("rest"), 1).otherwise(0)
    return sure.unionByName(edge.withColumn("copies", F.col("copies") + more).select(*columns))


def _nearer(chosen: DataFrame) -> DataFrame:
    """One more document of each source: the one that brings its sum nearest the target."""
    sums = chosen.groupBy("source").agg(
        F.max("target").alias("t"), F.max("source_size").alias("n"), F.sum(F.col("size") * F.col("copies")).alias("taken"))
    gaps = sums.filter("n > 0").select(F.col("source").alias("s"), (F.col("t") - F.col("taken")).alias("gap"), F.floor(F.col("t") / F.col("n")).alias("whole"))
    rows = chosen.join(gaps, chosen.source.eqNullSafe(gaps.s), "left")
    free = (F.col("copies") == F.col("whole")) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("gap"))
    key = F.struct(-F.abs(F.col("gap") - F.col("size")), "size", "text_hash", "doc_id")
    best = rows.filter(free).groupBy("s").agg(F.max(key).alias("best")).withColumnRenamed("s", "b")
    rows = rows.join(best, F.col("s").eqNullSafe(F.col("b")), "left")
    hit = F.coalesce(free & (key == F.col("best")), F.lit(False))
    first = F.row_number().over(W.partitionBy("source").orderBy("doc_id"))
    more = rows.filter(hit).withColumn("copies", (F.col("copies") + F.when(first == 1, 1).otherwise(0)).cast("int"))
    return rows.filter(~hit).select(*chosen.columns).unionByName(more.select(*chosen.columns))
