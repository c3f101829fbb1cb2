"""Shared steps of large jobs: they do their work once, in few tasks, with the plain results."""

import random
import re
import threading
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from tabulyte.functions import text as tx
from tabulyte.operators import models as mo, neighbours as nb, terms, text_model

ODD = ["http://a.b www.c @me Hello, World 12", "", None, "  a  b ", "ÉCOLE école ÀB", "WWW.X.Y@z\n\tq http", "x@", "www www. @ http@a b", "a-b_c d\x0beİI", "ß﻿A😀B"]


def plain_letters(text):
    # Spark's \s and \w are those of ASCII
    low = re.sub(r"http\S+|www\.\S+", "", (text or "").lower(), flags=re.A)
    return re.sub(r"[^a-z\s]", " ", re.sub(r"@\w+", "", low, flags=re.A), flags=re.A)


def test_cleaning_like_plain_patterns(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "id long, text string")
    low = F.lower(F.coalesce("text", F.lit("")))
    letters = F.regexp_replace(F.regexp_replace(F.regexp_replace(low, tx.LINKS, ""), tx.HANDLES, ""), r"[^a-z\s]", " ")
    rows = text_model.PipelineModel(stages=text_model.word_stages()).transform(df).select(
        "text", letters.alias("letters"), tx.letters_only("text").alias("mine"), tx.clean_spaced("text").alias("spaced"), "clean", "words", "kept",
        terms.tokens("text").alias("tokens"), tx.caps_ratio("text").alias("caps"), F.length(F.regexp_replace("text", r"\P{Lu}", "")).alias("upper")).collect()
    for r in rows:
        assert r.mine == r.letters and r.spaced == r.clean == re.sub(r"\s+", " ", r.letters, flags=re.A).strip(" ")
        assert r.tokens == r.words == [w for w in r.letters.split() if len(w) >= 2]
        assert r.caps is None or r.caps == pytest.approx(r.upper / max(len(r.text), 1))
    assert [r.letters for r in rows if (r.text or "").isascii()] == [plain_letters(t) for t in ODD if (t or "").isascii()]


@pytest.mark.parametrize("limit", [1, 3, 7, 12, 500])
def test_pairs_of_rare_words_are_not_counted(spark, limit):
    rng = random.Random(limit)
    lists = [[rng.choice("aa bb cc dd ee ff gg hh".split()[: rng.randrange(1, 9)]) for _ in range(rng.randrange(9))] for _ in range(60)]
    words = spark.createDataFrame([(w,) for w in lists], "_w array<string>").repartition(4)
    grams = Counter(g for w in lists for g in [*w, *map(" ".join, zip(w, w[1:]))])
    expected = sorted(grams.items(), key=lambda p: (-p[1], p[0]))[:limit]
    assert [tuple(r) for r in terms.vocabulary(words, limit, (1, 2)).orderBy(F.desc("total"), "term").collect()] == expected


def test_term_counts_of_repeated_and_empty_rows(spark):
    rows = [(1, "one two one"), (1, "two"), (2, None), (3, ""), (None, "two one"), (4, "A b")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = {(r.id, r.term): r.tf for r in terms.term_counts(df, "text", "id", sizes=(1, 2)).collect()}
    assert got == {(1, "one"): 2, (1, "two"): 2, (1, "one two"): 1, (1, "two one"): 1, (None, "two"): 1, (None, "one"): 1, (None, "two one"): 1}


def test_vectors_follow_the_training_rows(spark):
    rows = [(0, ["aa", "bb", "aa"]), (0, ["bb", "cc"]), (0, []), (1, ["dd", "dd", "dd", "cc"])]
    words = spark.createDataFrame(rows, "fold int, kept array<string>")
    seen = F.col("fold") != 1
    counts = text_model.gram_counts(words, False, n=F.count_if(seen))
    stages, vectors = text_model.fit_vectors(words, seen, counts, F.col("n"), 2, False, ["fold"])
    assert stages[-3].vocabulary == ["aa", "bb"]  # cc and dd are rarer among the training rows
    aa, bb = 2 * (np.log(4 / 2) + 1), np.log(4 / 3) + 1
    got = sorted(tuple(DenseVector(r.features.toArray())) for r in vectors.collect())
    assert np.allclose(got, sorted([(aa / np.hypot(aa, bb), bb / np.hypot(aa, bb)), (0, 1), (0, 0), (0, 0)]))


def test_benchmark_cleans_once(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, i % 2, " ".join(rng.choice(["good fine nice", "bad poor worse"][i % 2].split()) for _ in range(8))) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y int, text string")
    calls, plain = [], text_model.word_stages
    monkeypatch.setattr(text_model, "word_stages", lambda text="text": calls.append(text) or plain(text))
    out = text_model.benchmark(df, {"logistic": mo.logistic("y"), "naive_bayes": mo.naive_bayes("y")}, "id", "y", folds=3, max_features=50, bigrams=True).collect()
    assert calls == ["text"]
    assert {r.model: (r.auc, r.f1) for r in out} == {"logistic": (1.0, 1.0), "naive_bayes": (1.0, 1.0)}


def test_fits_run_side_by_side_in_order(spark):
    both = threading.Barrier(3, timeout=30)
    assert mo.together(spark, [lambda i=i: (both.wait(), i)[1] for i in range(3)]) == [0, 1, 2]
    assert mo.together(spark, []) == []


def test_boosting_of_few_rows_takes_few_tasks(spark):
    seen = []

    class Watched(GBTClassifier):
        def _fit(self, dataset):
            seen.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    df = spark.range(200).select((F.col("id") % 2).alias("y"), F.col("id").cast("double").alias("x")).repartition(8)
    mo.fit(df, mo.feature_stages(["x"], scale=False), Watched(labelCol="y", maxIter=2))
    assert seen == [1]


def test_neighbours_with_small_parts(spark, monkeypatch):
    monkeypatch.setattr(nb, "VISITORS_PER_TASK", 7)
    monkeypatch.setattr(nb, "ASKS_PER_TASK", 5)
    monkeypatch.setattr(nb, "FAN", 4)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(120, 2)), 3)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double")
    got = {}
    for r in nb.knn_rows(df, "id", ["a", "b"], 3, 4).collect():
        got.setdefault(r.id, []).append(r.d)
    far = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), axis=1)[:, 1:4]
    assert {i: pytest.approx(sorted(d)) for i, d in got.items()} == {i: list(far[i]) for i in range(120)}
