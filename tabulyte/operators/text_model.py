"""Text classification pipelines."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF, CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, SQLTransformer, StopWordsRemover,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from tabulyte.functions.text import HANDLES, LINKS
from tabulyte.operators.models import metric_table, released, score, together, training_rows
from tabulyte.operators.prep import kfold_stratified
from tabulyte.session import written

# The cleaning step of functions.text.clean_spaced, as stages that are saved with the model.
STRIP = "CASE WHEN contains({x}, 'http') OR contains({x}, 'www.') THEN regexp_replace({x}, r'{links}', '') ELSE {x} END"
CLEAN = [
    "SELECT *, lower(coalesce({c}, '')) AS low FROM __THIS__",
    f"SELECT *, {STRIP} AS bare FROM __THIS__",
    "SELECT *, trim(regexp_replace(CASE WHEN contains(bare, '@') THEN regexp_replace(bare, r'{handles}', '') ELSE bare END, r'[^a-z]+', ' ')) AS clean FROM __THIS__",
    "SELECT *, filter(split(clean, ' '), w -> length(w) >= 2) AS words FROM __THIS__",
]
#: Folds whose vectors are kept at the same time.
FOLDS = 3
#: Rows of a task at least, in the passes of a fit: smaller tasks cost more to start than to run.
TASK_ROWS = 4096


def word_stages(text: str = "text") -> list:
    """Clean, split and drop stop words: the column `kept`."""
    clean = [SQLTransformer(statement=s.format(c=text, x="low", links=LINKS, handles=HANDLES)) for s in CLEAN]
    return [*clean, StopWordsRemover(inputCol="words", outputCol="kept")]


def gram_stages(bigrams: bool = False) -> list:
    """The terms to count, `grams`: words, or words and pairs of neighbours."""
    pairs = [NGram(n=2, inputCol="kept", outputCol="pairs")] if bigrams else []
    return [*pairs, SQLTransformer(statement=f"SELECT *, {'concat(kept, pairs)' if bigrams else 'kept'} AS grams FROM __THIS__")]


def gram_counts(words: DataFrame, bigrams: bool, **measures) -> DataFrame:
    """`(term, measures)` of the rows' `kept` words, one row per term."""
    grams = PipelineModel(stages=gram_stages(bigrams)).transform(words)
    return grams.select(*[c for c in words.columns if c != "kept"], F.explode("grams").alias("term")).groupBy("term").agg(
        *[m.alias(n) for n, m in measures.items()]
    )


def fit_vectors(words: DataFrame, train: Column, counts: DataFrame, n: Column, max_features: int, bigrams: bool, keep: Sequence[str]) -> tuple[list, DataFrame]:
    """Stages from `kept` words to vectors `tf * (ln((1+n)/(1+df)) + 1)` of length 1, as
    `terms.tfidf` weighs them, and the vectors of all rows, to be `released`.  Vocabulary
    (the terms of largest `n`, the smaller term at a tie) and weights follow the rows of `train`."""
    top = counts.select("term", n.alias("n")).filter("n > 0").orderBy(F.desc("n"), "term").limit(max_features)
    counter = CountVectorizerModel.from_vocabulary([r.term for r in top.orderBy(F.desc("n"), "term").collect()], "grams", "counts")
    stages = [*gram_stages(bigrams), counter]
    counted = training_rows(PipelineModel(stages=stages).transform(words).select(*keep, "counts"))
    idf = IDF(inputCol="counts", outputCol="plain").fit(counted.filter(train).select("counts"))
    weights = ElementwiseProduct(scalingVec=Vectors.dense(idf.idf.toArray() + 1.0), inputCol="counts", outputCol="weighted")
    scaled = [weights, Normalizer(inputCol="weighted", outputCol="features")]
    tasks = counted.coalesce(counted.count() // TASK_ROWS + 1)
    vectors = training_rows(PipelineModel(stages=scaled).transform(tasks).select(*keep, "features"))
    released(counted)
    return [*stages, *scaled], vectors


def fit_text_model(df: DataFrame, estimator, text: str = "text", max_features: int = 5000, bigrams: bool = False) -> PipelineModel:
    """Text stages and classifier as one model.

    The texts are cleaned once: the vocabulary, the weights and the vectors come from
    the written words.  The vectors are kept for the classifier's passes.
    """
    label = estimator.getLabelCol()
    cleaning = word_stages(text)
    words = written(PipelineModel(stages=cleaning).transform(df).select(label, "kept"), "words")
    counts = gram_counts(words, bigrams, n=F.count(F.lit(1)))
    stages, vectors = fit_vectors(words, F.lit(True), counts, F.col("n"), max_features, bigrams, [label])
    model = PipelineModel(stages=[*cleaning, *stages, estimator.fit(vectors)])
    released(vectors)
    return model


def benchmark(df: DataFrame, estimators: Mapping[str, object], id_col: str, label: str, text: str = "text", folds: int = 5,
              max_features: int = 5000, bigrams: bool = False) -> DataFrame:
    """Mean AUC, average precision and F1 of text classifiers over stratified folds, with
    the seconds of fitting (fits run side by side).  Vocabulary and weights see the
    training folds only; the models of a fold share its vectors.  Texts are cleaned and
    terms are counted once, per fold: training folds have the total less their own fold's count."""
    spark = df.sparkSession
    kept = PipelineModel(stages=word_stages(text)).transform(df).select(id_col, label, "kept")
    words = written(kfold_stratified(kept, [id_col], label, folds).repartition(F.col(id_col)), "folds")
    sums = {f"n{k}": F.count_if(F.col("fold") != k) for k in range(folds)}
    counts = written(gram_counts(words, bigrams, **sums), "terms")
    seconds = dict.fromkeys(estimators, 0.0)

    def one_fold(k: int) -> DataFrame:
        seen = F.col("fold") != k
        _, vectors = fit_vectors(words, seen, counts, F.col(f"n{k}"), max_features, bigrams, [id_col, label, "fold"])

        def one_model(name: str) -> DataFrame:
            start = time.perf_counter()
            model = PipelineModel(stages=[estimators[name].fit(vectors.filter(seen))])
            seconds[name] += time.perf_counter() - start
            return score(model, vectors.filter(~seen), [id_col, label, "fold"]).select(F.lit(name).alias("model"), "*")

        scored = together(spark, [lambda name=name: one_model(name) for name in estimators])
        out = written(reduce(DataFrame.unionByName, scored), "scores")
        released(vectors)
        return out

    stacked = reduce(DataFrame.unionByName, together(spark, [lambda k=k: one_fold(k) for k in range(folds)], FOLDS))
    table = metric_table(stacked, label, ["model", "fold"])
    means = table.groupBy("model").agg(*[F.avg(c).alias(c) for c in ("auc", "average_precision", "f1")])
    times = spark.createDataFrame(list(seconds.items()), "model string, fit_seconds double")
    return means.join(times, "model")


def score_text(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Label and probability of each text; works on tables and on streams."""
    return model.transform(df).select(
        *keep, F.col("prediction").cast("int").alias("label"), vector_to_array("probability")[1].alias("probability")
    )
