"""Term statistics in long form: one row per document and term.

A document's tokens are made by column expressions inside its row, and written once.
They are shuffled once, by id; counting terms and normalising weights then need no
further shuffle.  Vocabularies are limited by `max_features`, so they can be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tabulyte.functions.text import letter_words
from tabulyte.operators.sampling import top_per_group
from tabulyte.session import written

BROADCAST_TERMS = 200_000


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def tokens(text: str, stop: Sequence[str] = ()) -> Column:
    """Cleaned words of at least two letters, without stop words."""
    parts = letter_words(text)
    keep = (lambda w: (F.length(w) >= 2) & ~w.isin(list(stop))) if stop else (lambda w: F.length(w) >= 2)
    return F.filter(parts, keep)


def ngrams(words: Column, sizes: tuple[int, int]) -> Column:
    """Single words and pairs of neighbours, as `sizes` asks."""
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    if sizes == (1, 1):
        return words
    return pairs if sizes == (2, 2) else F.concat(words, pairs)


def exploded(df: DataFrame, text: str, keep: Sequence[str], stop: Sequence[str] = (), sizes=(1, 1)) -> DataFrame:
    words = df.select(*keep, tokens(text, stop).alias("_w"))
    return words.select(*keep, F.explode(ngrams(F.col("_w"), sizes)).alias("term"))


def class_counts(df: DataFrame, text: str, label: str, stop: Sequence[str] = (), sizes=(1, 1)) -> DataFrame:
    """Occurrences of each token per class."""
    return exploded(df, text, [label], stop, sizes).groupBy(label, "term").agg(F.count(F.lit(1)).alias("n"))


def _counted(terms: DataFrame) -> DataFrame:
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("total"))


def _most(counts: DataFrame, max_features: int) -> DataFrame:
    return counts.orderBy(F.desc("total"), "term").limit(max_features)


def vocabulary(words: DataFrame, max_features: int, sizes=(1, 1)) -> DataFrame:
    """The most frequent terms of the word lists `_w` with their counts; the smaller term
    wins a tie.

    A pair is no more frequent than either of its words.  So beside single words, only
    pairs of words as frequent as the last of the `max_features` words can be among the
    terms, and no other pairs are counted."""
    if sizes != (1, 2):
        return _most(_counted(words.select(F.explode(ngrams(F.col("_w"), sizes)).alias("term"))), max_features)
    single = written(_counted(words.select(F.explode("_w").alias("term"))), "words")
    top = _most(single, max_features).agg(F.min("total").alias("least"), F.count(F.lit(1)).alias("n")).first()
    often = single.filter(F.col("total") >= (top["least"] if top["n"] == max_features else 0)).select("term")
    often = _bounded(often, often.count())
    after = F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(0)))
    before = F.slice("_w", 1, F.greatest(F.size("_w") - 1, F.lit(0)))
    pairs = words.select(F.explode(F.zip_with(before, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p")).select("p.a", "p.b")
    for side in ("a", "b"):
        pairs = pairs.join(often.withColumnRenamed("term", side), side)
    return _most(single.unionByName(_counted(pairs.select(F.concat("a", F.lit(" "), "b").alias("term")))), max_features)


def _bounded(table: DataFrame, max_features: int) -> DataFrame:
    return F.broadcast(table) if max_features <= BROADCAST_TERMS else table


def term_counts(df: DataFrame, text: str, doc: str, keep: Sequence[str] = (), max_features: int = 2000,
                stop: Sequence[str] = (), sizes=(1, 1)) -> DataFrame:
    """`(doc, keep, term, tf)` over the most frequent terms."""
    words = written(df.select(doc, *keep, tokens(text, stop).alias("_w")), "tokens")
    vocab = written(vocabulary(words, max_features, sizes).select("term"), "vocabulary")
    long = words.repartition(doc).select(doc, *keep, F.explode(ngrams(F.col("_w"), sizes)).alias("term"))
    return long.join(_bounded(vocab, max_features), "term").groupBy(doc, *keep, "term").agg(
        F.count(F.lit(1)).alias("tf")
    )


def tfidf(counts: DataFrame, doc: str, n_docs: Column, sublinear: bool = False, max_features: int = 2000) -> DataFrame:
    """Weights `tf * (ln((1+n)/(1+df)) + 1)`, scaled to length 1 per document."""
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    tf = 1 + F.ln("tf") if sublinear else F.col("tf").cast("double")
    weighted = counts.join(_bounded(frequency, max_features), "term").withColumn("_n", n_docs).withColumn(
        "_w", tf * (F.ln((1 + F.col("_n")) / (1 + F.col("df"))) + 1)
    )
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(doc)))
    return weighted.withColumn("weight", F.col("_w") / length).drop("_w", "_n", "df")


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def chi2_terms(counts: DataFrame, labelled: DataFrame, label: str) -> DataFrame:
    """Chi-square of each term's occurrences against the 0/1 class of the rows.

    Expected occurrences follow the share of each class among all rows.  Also the
    log ratio of class occurrences and the mean label of the rows with the term.
    """
    share = labelled.agg(F.avg(F.col(label).cast("double"))).scalar()
    per = counts.groupBy("term").agg(
        F.sum(F.when(F.col(label) == 1, F.col("tf")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 0, F.col("tf")).otherwise(0)).alias("neg"),
        F.avg(F.col(label).cast("double")).alias("mean_label"),
    ).withColumn("_p", share)
    total = F.col("pos") + F.col("neg")
    part = lambda seen, p: F.pow(seen - total * p, 2) / (total * p)
    return per.select(
        "term", "pos", "neg", "mean_label",
        (part(F.col("pos"), F.col("_p")) + part(F.col("neg"), 1 - F.col("_p"))).alias("chi2"),
        F.ln((F.col("pos") + 0.1) / (F.col("neg") + 0.1)).alias("log_odds"),
    )


def top_chi2(scores: DataFrame, k: int = 20) -> DataFrame:
    direction = F.when(F.col("mean_label") > 0.5, "positive").otherwise("negative")
    return scores.withColumn("direction", direction).orderBy(F.desc("chi2"), "term").limit(k)


def top_log_odds(scores: DataFrame, k: int = 10) -> DataFrame:
    """Strongest terms per number of words and sign of the log odds."""
    sided = scores.filter("log_odds <> 0").withColumns({
        "words": F.size(F.split("term", " ")),
        "direction": F.when(F.col("log_odds") > 0, "positive").otherwise("negative"),
    })
    return top_per_group(sided, ["words", "direction"], [F.desc("chi2"), F.col("term")], k)


def top_tfidf_per_class(weights: DataFrame, sizes: DataFrame, label: str, k: int = 15) -> DataFrame:
    """Mean weight of a term over the rows of a class; `sizes` is `(label, rows)`."""
    sums = weights.groupBy(label, "term").agg(F.sum("weight").alias("_s")).join(sizes, label)
    means = sums.select(label, "term", F.round(F.col("_s") / F.col("rows"), 10).alias("mean_weight"))
    return top_per_group(means, [label], [F.desc("mean_weight"), F.col("term")], k)


def top_bigrams(df: DataFrame, text: str, label: str, stop: Sequence[str] = (), k: int = 10) -> DataFrame:
    """Most frequent word pairs per class, weighted to length 1 over the k pairs."""
    counts = class_counts(df, text, label, stop, (2, 2))
    top = top_per_group(counts, [label], [F.desc("n"), F.col("term")], k)
    length = F.sqrt(F.sum((F.col("n") * F.col("n")).cast("double")).over(W.partitionBy(label)))
    return top.withColumn("weight", F.col("n") / length)


def cloud_frequencies(df: DataFrame, text: str, label: str, stop: Sequence[str] = (), k: int = 100) -> DataFrame:
    """Most frequent tokens per class relative to the first of them."""
    top = top_per_group(class_counts(df, text, label, stop), [label], [F.desc("n"), F.col("term")], k)
    return top.withColumn("weight", F.col("n") / F.max("n").over(W.partitionBy(label)))
