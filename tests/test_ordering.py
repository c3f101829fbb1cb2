"""Blocked orders against pandas, with hot keys, ties, nulls and text."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulyte.operators import ordering as od, ranks
from tabulyte.operators.joins import nearest_within
from tabulyte.operators.sampling import sample_balanced


@pytest.fixture(autouse=True, params=["blocks", "one block"])
def ordering_mode(request, monkeypatch):
    """Every order is cut into blocks, or small ones are one."""
    if request.param == "blocks":
        monkeypatch.setattr(od, "ONE_BLOCK", -1)



@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 4000
    return pd.DataFrame({
        "id": np.arange(n), "k": rng.choice(["hot", "b", "c"], n, p=[0.8, 0.15, 0.05]),
        "v": np.where(rng.random(n) < 0.35, 5.0, np.round(rng.lognormal(0, 2, n), 3)),
    })


@pytest.mark.parametrize("partitions", ["2", "8", "60"])
def test_running_and_positions(spark, frame, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.createDataFrame(frame)
        out = od.running(df, ["v", "id"], {"s": ("sum", "v"), "m": ("max", "id"), "pos": ("sum", F.lit(1))}, ["k"], totals=True)
        got = out.toPandas().sort_values(["k", "v", "id"])
        want = frame.sort_values(["k", "v", "id"])
        g = want.groupby("k")
        assert np.allclose(got["s"], g["v"].cumsum())
        assert (got["m"].to_numpy() == g["id"].cummax().to_numpy()).all()
        assert (got["pos"].to_numpy() == g.cumcount().to_numpy() + 1).all()
        assert (got["pos_total"].to_numpy() == g["id"].transform("size").to_numpy()).all()
        back = od.running(df, ["v", "id"], {"s": ("sum", "v")}, ["k"], reverse=True).toPandas().sort_values(["k", "v", "id"])
        suffix = want[::-1].groupby("k")["v"].cumsum()[::-1]
        assert np.allclose(back["s"], suffix)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_null_keys_and_text_order(spark):
    rows = [("a", "x"), ("b", "x"), ("é", None), ("c", None), ("aa", "x")]
    df = spark.createDataFrame(rows, "t string, k string")
    got = {(r.t, r.k): r.pos for r in od.positions(df, ["t"], ["k"]).collect()}
    assert got == {("a", "x"): 1, ("aa", "x"): 2, ("b", "x"): 3, ("c", None): 1, ("é", None): 2}


def test_quantiles(spark, frame):
    df = spark.createDataFrame(frame)
    got = od.quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.975}, ["k"]).toPandas().set_index("k")
    want = frame.groupby("k")["v"].quantile([0.1, 0.5, 0.975]).unstack()
    assert np.allclose(got.loc[want.index, ["a", "b", "c"]], want)


def test_blocks_are_balanced_and_repeatable(spark, frame):
    df = spark.createDataFrame(frame)
    a = od.with_blocks(df, ["v", "id"]).toPandas().set_index("id")["_block"]
    b = od.with_blocks(df.repartition(5), ["v", "id"]).toPandas().set_index("id")["_block"]
    assert (a.sort_index() == b.sort_index()).all()
    assert a.value_counts().max() < len(frame) / 3


def test_rank_pct(spark, frame):
    got = ranks.rank_pct(spark.createDataFrame(frame), "v", "r").toPandas().set_index("id")["r"]
    assert np.allclose(got.sort_index(), frame.set_index("id")["v"].rank(pct=True))


def test_balanced_sample_sizes(spark, frame):
    got = sample_balanced(spark.createDataFrame(frame), ["id"], "k", 150).toPandas()
    assert got.groupby("k").size().to_dict() == {"hot": 150, "b": 150, "c": 150}
    assert got["id"].is_unique


def test_nearest_with_a_crowded_score(spark):
    rng = np.random.default_rng(3)
    t = pd.DataFrame({"id": np.arange(600), "p": np.where(rng.random(600) < 0.4, 0.5, rng.random(600).round(3))})
    c = pd.DataFrame({"id": np.arange(1000, 1300), "p": (0.3 + 0.5 * rng.random(300)).round(3)})
    got = nearest_within(spark.createDataFrame(t), spark.createDataFrame(c), "p", "id", 0.05).toPandas().set_index("id")
    for row in t.itertuples():
        d = (c["p"] - row.p).abs()
        if d.min() <= 0.05 - 1e-9:
            assert got.loc[row.id, "distance"] == pytest.approx(d.min(), abs=1e-12)
        elif d.min() > 0.05 + 1e-9:
            assert row.id not in got.index


def test_wide_correlation_equals_the_narrow_one(spark):
    from tabulyte.operators import aggregates as ag

    rng = np.random.default_rng(8)
    x = pd.DataFrame(rng.normal(0, 1, (200, 14)) + rng.normal(0, 1, (200, 1)), columns=[f"c{i}" for i in range(14)])
    got = ag.corr_matrix(spark.createDataFrame(x), list(x)).toPandas().pivot(index="feature_a", columns="feature_b", values="r")
    assert np.allclose(got.loc[list(x), list(x)], x.corr())


def test_thinned_keeps_about_the_target(spark):
    df = spark.range(20_000)
    kept = od.thinned(df, ["id"], 2_000)
    assert 1_700 < kept.count() < 2_300
    assert kept.exceptAll(od.thinned(df.repartition(3), ["id"], 2_000)).count() == 0
    assert od.thinned(df, ["id"], 50_000).count() == 20_000
