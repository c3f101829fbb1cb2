"""Invariants of resampling, neighbours, survival, models and streaming."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tabulyte.operators.aggregates import corr_matrix
from tabulyte.operators.sampling import bootstrap, top_per_group
from tabulyte.operators import extra_trees as et, isolation, metrics as me, models as mo, neighbours as nb, ordering, prep, survival, text_model
from tabulyte.plans import anomalies, learning
from tabulyte.plans.registry import Tables
from tabulyte.session import landing_path
from tabulyte.streaming.scoring import score_stream

QUERIES = entry_point.queries()


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(0, 1, (300, 2)), rng.normal(6, 0.2, (200, 2)), np.repeat([[2.0, 2.0]], 120, axis=0)])
    return pd.DataFrame({"id": np.arange(len(x)), "a": x[:, 0], "b": x[:, 1]})


@pytest.mark.parametrize("leaf_rows", [10_000, 60, 15])
def test_knn_equals_brute_force(spark, cloud, leaf_rows):
    points = nb.weighted_points(spark.createDataFrame(cloud), "id", ["a", "b"])
    got = nb.knn(points, 7, leaf_rows).toPandas()
    assert (got.groupby("id")["w"].sum() == 7).all()
    x = cloud[["a", "b"]].to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    want = np.sort(d, axis=1)[:, :7]
    for pid, g in got.groupby("id"):
        g = g.sort_values(["d", "nb"])
        assert np.allclose(np.repeat(g["d"], g["w"]), want[pid], atol=1e-9)


def test_lof_equals_brute_force(spark, cloud):
    some = cloud.iloc[:500]
    got = nb.local_outlier_factor(spark.createDataFrame(some), "id", ["a", "b"], 10).toPandas().set_index("id")["lof"]
    x = some[["a", "b"]].to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1)[:, :10]
    near = np.take_along_axis(d, order, 1)
    lrd = 1 / (np.maximum(near[:, -1][order], near).mean(1) + 1e-10)
    assert np.allclose(got.sort_index(), lrd[order].mean(1) / lrd)


def test_smote_balances_and_interpolates(spark, cloud):
    df = spark.createDataFrame(cloud.assign(y=(cloud["id"] < 90).astype(int)))
    out = nb.smote(df, "id", ["a", "b"], "y").toPandas()
    assert out.groupby("y").size().nunique() == 1
    made, few = out[out["synthetic"]], cloud[cloud["id"] < 90]
    assert (made["y"] == 1).all()
    assert made["a"].between(few["a"].min(), few["a"].max()).all()
    again = nb.smote(df, "id", ["a", "b"], "y").toPandas()
    assert np.allclose(np.sort(out["a"]), np.sort(again["a"]))


def test_isolation_ranks_the_far_point_first(spark, cloud):
    far = pd.concat([cloud, pd.DataFrame({"id": [9999], "a": [40.0], "b": [-40.0]})])
    out = isolation.isolation_scores(spark.createDataFrame(far), "id", ["a", "b"], trees=25)
    assert out.orderBy(F.desc("score")).first().id == 9999


def test_folds_and_split(spark, cloud):
    df = spark.createDataFrame(cloud.assign(y=(cloud["id"] % 10 == 0).astype(int)))
    folds = prep.kfold_stratified(df, ["id"], "y", 5).toPandas()
    assert len(folds) == len(cloud) and folds["id"].is_unique
    sizes = folds.groupby(["y", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1) <= 1).all()
    split = prep.split_stratified(df, ["id"], "y", 0.2).toPandas()
    assert split.groupby("y")["is_test"].mean().sub(0.2).abs().lt(0.01).all()


def test_auc_is_symmetric_and_thresholds_hold(spark, sf):
    from tabulyte.plans.stand_ins import scored

    s = scored(Tables(spark, sf)).cache()
    auc = me.roc_auc(s).first().auc
    flipped = me.roc_auc(s.withColumn("y", 1 - F.col("y"))).first().auc
    assert 0 <= auc <= 1 and auc + flipped == pytest.approx(1)
    best = me.cost_threshold(s).first()
    assert 0.01 <= best.threshold <= 0.99 and best.cost <= best.default_cost


def test_cox_gradient_is_zero_at_the_estimate(spark):
    rng = np.random.default_rng(6)
    n = 300
    x = rng.normal(0, 1, (n, 2))
    t = np.ceil(8 * rng.exponential(1, n) * np.exp(-0.7 * x[:, 0]))
    e = (rng.random(n) < 0.7).astype(int)
    df = pd.DataFrame({"t": t.astype(int), "e": e, "a": x[:, 0], "b": x[:, 1]})
    out = survival.cox(spark.createDataFrame(df), "t", "e", ["a", "b"], penalty=0.1).toPandas().set_index("feature")["coef"]
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    beta = out[["a", "b"]].to_numpy() * x.std(0, ddof=1)
    w, grad = np.exp(z @ beta), np.zeros(2)
    for time in np.unique(t[e == 1]):
        risk, ev = t >= time, (t == time) & (e == 1)
        d = ev.sum()
        for l in range(d):
            den = w[risk].sum() - l / d * w[ev].sum()
            num = (w[risk, None] * z[risk]).sum(0) - l / d * (w[ev, None] * z[ev]).sum(0)
            grad -= num / den
        grad += z[ev].sum(0)
    assert np.abs(grad / n - 0.1 * beta).max() < 1e-6
    assert out["a"] > 0.2


def test_cox_says_whether_it_rested(spark):
    df = spark.range(60).selectExpr("id % 7 AS t", "CAST(id % 3 > 0 AS INT) AS e", "CAST(id % 5 AS DOUBLE) AS a")
    assert survival.cox(df, "t", "e", ["a"]).first().converged
    assert not survival.cox(df, "t", "e", ["a"], steps=1).first().converged


@pytest.mark.parametrize("one_block", [-1, 65_536])
def test_survival_over_many_durations(spark, monkeypatch, one_block):
    """As many durations as rows, cut into blocks or not."""
    monkeypatch.setattr(ordering, "ONE_BLOCK", one_block)
    rng = np.random.default_rng(7)
    t, e, g = rng.permutation(3000) / 7, rng.random(3000) < 0.4, rng.integers(0, 2, 3000)
    df = spark.createDataFrame(pd.DataFrame({"t": t, "e": e.astype(int), "g": g})).repartition(6)
    got = survival.kaplan_meier(df, "t", "e", ["g"]).toPandas().sort_values(["g", "t"])
    for k in (0, 1):
        order = np.argsort(t[g == k])
        ev = e[g == k][order]
        assert np.allclose(got[got["g"] == k]["survival"], np.cumprod(1 - ev / np.arange(len(ev), 0, -1)))
    order = np.argsort(t)
    ev, gr = e[order], g[order]
    risk, risk1 = np.arange(3000, 0, -1), gr[::-1].cumsum()[::-1]
    share = risk1 / risk
    row = survival.logrank(df, "t", "e", "g").first()
    assert row.observed == (ev * gr).sum() and row.expected == pytest.approx((ev * share).sum())
    assert row.variance == pytest.approx((ev * share * (1 - share) * (risk > 1)).sum())


def test_survival_never_rises(spark, sf):
    out = QUERIES["surv_kaplan_meier"](spark, sf).toPandas().sort_values(["grp", "tenure"])
    assert (out.groupby("grp")["survival"].diff().dropna() <= 1e-12).all()


def test_cross_validation_scores_are_rates(spark, sf):
    out = QUERIES["ml_cross_validate"](spark, sf).toPandas().set_index("metric")
    assert out["mean"].between(0, 1).all() and set(out.index) == {"auc", "average_precision", "f1"}


def test_shapley_adds_up(spark, sf):
    t = Tables(spark, sf)
    train, test = learning.parts(t)
    model = mo.fit(train, mo.feature_stages(learning.FEATURES), mo.logistic("y"))
    parts = mo.sampled_shapley(model, test, learning.FEATURES, "doc_id", orders=3)
    total = parts.groupBy("doc_id").agg(F.sum("contribution").alias("s")).toPandas()
    assert total["s"].between(-1, 1).all() and len(total) == test.count()


def test_stream_equals_batch(spark, sf):
    t = Tables(spark, sf)
    path = learning.saved_text_model(t)
    keep = ["conv_id", "turn"]
    batch = text_model.score_text(PipelineModel.load(path), t.conversations, keep)
    out = score_stream(spark, f"{sf}/conversations.parquet", t.conversations.schema, path, keep,
                       landing_path(spark, "scored"), landing_path(spark, "stream"))
    stream = spark.read.parquet(out)
    both = batch.join(stream.withColumnsRenamed({"label": "l", "probability": "q"}), keep)
    assert stream.count() == batch.count() == both.count() > 0
    assert both.filter((F.col("label") != F.col("l")) | (F.abs(F.col("probability") - F.col("q")) > 1e-12)).count() == 0


@pytest.mark.parametrize("key", ["ml_pca", "ml_kmeans", "ml_tree_rules", "ml_counterfactual", "ml_odds_ratio", "viz_qq",
                                 "ts_holt_winters", "ml_naive_bayes", "ml_extra_trees", "sample_replace"])
def test_runs(spark, sf, key):
    assert QUERIES[key](spark, sf).count() > 0


def brute_neighbours(rows, k):
    out = {}
    for i, *x in rows:
        far = sorted((float(np.hypot(x[0] - y[0], x[1] - y[1])), j) for j, *y in rows if j != i)
        out[i] = [j for _, j in far[:k]]
    return out


def near_ids(spark, rows, k, leaf_rows):
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = nb.knn_rows(df, "id", ["a", "b"], k, leaf_rows).orderBy("id", "d", "nb").collect()
    out = {}
    for r in got:
        out.setdefault(r.id, []).append(r.nb)
    return out


@pytest.mark.parametrize("leaf_rows", [20, 10_000])
def test_neighbour_ids_on_a_grid(spark, leaf_rows):
    rows = [(7 * x + 131 * y, float(x), float(y)) for x in range(12) for y in range(12)]
    assert near_ids(spark, rows, 5, leaf_rows) == brute_neighbours(rows, 5)


@pytest.mark.parametrize("leaf_rows", [2, 4, 10_000])
def test_neighbours_of_repeated_rows(spark, leaf_rows):
    rows = [(100 - i, float(i % 11), float(i % 4 == 0)) for i in range(90)]
    assert near_ids(spark, rows, 5, leaf_rows) == brute_neighbours(rows, 5)
    assert near_ids(spark, rows, 40, leaf_rows) == brute_neighbours(rows, 40)


def test_search_opens_only_near_leaves(spark, monkeypatch):
    """Three levels of nodes, one axis mostly zero; visits follow k, not the leaves."""
    monkeypatch.setattr(nb, "FAN", 4)
    rng = np.random.default_rng(2)
    rows = [(i, 0.0 if i % 3 else float(rng.integers(0, 50)), float(rng.integers(0, 4000)) / 7) for i in range(1500)]
    assert near_ids(spark, rows, 3, 12) == brute_neighbours(rows, 3)
    asked = []
    monkeypatch.setattr(nb, "_round", lambda state, *a, f=nb._round: asked.append(state.select(F.sum(F.least(F.size("todo"), F.lit(a[-1])))).first()[0]) or f(state, *a))
    near_ids(spark, rows, 3, 12)
    leaves = 1500 / 24
    assert sum(asked) / 1500 < leaves / 4


def test_neighbours_skip_incomplete_rows(spark):
    rows = [(1, 0.0, 0.0), (2, 1.0, 0.0), (3, None, 0.0), (4, float("nan"), 1.0), (5, 5.0, 0.0)]
    assert near_ids(spark, rows, 2, 10) == {1: [2, 5], 2: [1, 5], 5: [2, 1]}


def test_mostly_zero_axis_still_divides():
    rng = np.random.default_rng(0)
    x = np.column_stack([np.where(rng.random(4000) < 0.6, 0.0, 1e6 * rng.random(4000)), rng.random(4000)])
    tree = nb._cut_space(x, 64)
    sizes = np.bincount(nb._leaf_of(x, tree))
    assert len(sizes) == 64 and sizes.max() < 4 * sizes.mean()


def test_stream_of_a_folder_table(spark, sf, tmp_path):
    t = Tables(spark, sf)
    folder = str(tmp_path / "conversations.parquet")
    t.conversations.repartition(3).write.parquet(folder)
    path = learning.saved_text_model(t)
    out = score_stream(spark, folder, t.conversations.schema, path, ["conv_id", "turn"], landing_path(spark, "scored"), landing_path(spark, "stream"))
    assert spark.read.parquet(out).count() == t.conversations.count()


def test_bootstrap_is_exact_and_repeatable(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey")
    one = bootstrap(orders, ["o_orderkey"]).collect()
    assert len(one) == orders.count() and sorted(one) == sorted(bootstrap(orders.repartition(7), ["o_orderkey"]).collect())
    assert bootstrap(orders.limit(0), ["o_orderkey"]).count() == 0 and bootstrap(orders, ["o_orderkey"], 10).count() == 10


def test_correlations_of_any_width(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 14)) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = 5.0
    frame = pd.DataFrame(x, columns=[f"f{i}" for i in range(14)])
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame.columns))
    expected = frame.corr()
    for width in (12, 13, 14):
        got = corr_matrix(df, list(frame.columns[:width])).collect()
        assert len(got) == width**2
        for r in got:
            assert np.isclose(r.r, expected.loc[r.feature_a, r.feature_b], atol=1e-9, equal_nan=True)


def test_top_rows_of_a_crowded_group(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 2)
    got = top_per_group(df, ["g"], [F.desc("id")], 1500).collect()
    assert {r.id for r in got} == set(range(2000, 5000)) and max(r["rank"] for r in got) == 1500


def plain_extra_trees(x, y, tree, depth, per_node, seed):
    """One tree grown node by node: {node: (feature, cut) or None} and class shares."""
    out, rates, open_ = {}, {}, {1: np.arange(len(x))}
    while open_:
        k, rows = open_.popitem()
        n = np.bincount(y[rows], minlength=2)
        rates[k] = n / n.sum()
        out[k] = None
        if k >= 1 << depth or np.count_nonzero(n) < 2:
            continue
        ranges = {f: (x[rows, f].min(), x[rows, f].max()) for f in range(x.shape[1])}
        best = None
        for f, c in et.drawn(seed, tree, k, ranges, per_node).items():
            left = np.bincount(y[rows[x[rows, f] < c]], minlength=2)
            loss = sum(s.sum() - (s * s).sum() / s.sum() for s in (left, n - left))
            if best is None or (loss, f) < best[:2]:
                best = (loss, f, c)
        if best:
            _, f, c = best
            out[k] = (f, c)
            open_[2 * k], open_[2 * k + 1] = rows[x[rows, f] < c], rows[x[rows, f] >= c]
    return out, rates


def test_extra_trees_equal_plain_growth(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 4)), 1)
    x[:, 3] = 1.0  # a constant feature is never cut
    y = ((x[:, 0] + x[:, 1] + rng.normal(0, 0.5, 400)) > 0).astype(int)
    rows = [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))] + [(900, None, 1.0, 1.0, 1.0, 1), (901, 1.0, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y int").repartition(6)
    model = et.fit_extra_trees(df, list("abcd"), "y", trees=7, depth=4)
    cuts = set()
    for t in range(7):
        nodes, rates = plain_extra_trees(x, y, t, 4, 2, et.SEED)
        for k in range(1, 32):
            cut = nodes.get(k)
            assert (model.feature[t, k], model.cut[t, k]) == (cut or (-1, 0.0))
            assert np.allclose(model.rates[t, k], rates.get(k, 0.0))
        cuts.update(c for c in nodes.values() if c)
    assert len(cuts) > 40  # drawn, not taken from a few bins
    out = et.score_trees(model, df, list("abcd"), ["id", "y"]).toPandas().set_index("id")
    assert np.allclose(out.loc[range(400), "p"], model.probabilities(x)[:, 1]) and len(out) == 402


def test_extra_trees_rank_like_a_forest(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 5))
    y = ((x[:, 0] * x[:, 1] + x[:, 2] + rng.normal(0, 0.5, 1500)) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, e double, y int")
    train, test = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    names = list("abcde")
    forest = mo.score(mo.fit(train, mo.feature_stages(names, False), mo.random_forest("y", 60, 6)), test, ["id", "y"])
    extra = et.score_trees(et.fit_extra_trees(train, names, "y", 60, 6), test, names, ["id", "y"])
    area = lambda s: me.roc_auc(s, "y", "p").scalar().alias("auc")
    one, two = (spark.range(1).select(area(s)).first().auc for s in (forest, extra))
    assert two > 0.8 and abs(one - two) < 0.06


def test_extra_trees_of_one_class_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0.5, 1), (2, 0.7, 1)], "id long, a double, y int")
    model = et.fit_extra_trees(df, ["a"], "y", trees=2, depth=3)
    assert [r.p for r in et.score_trees(model, df, ["a"], ["id"]).collect()] == [1.0, 1.0]
    assert et.fit_extra_trees(df.limit(0), ["a"], "y", trees=2, depth=3).feature.max() == -1


def test_consensus_joins_the_flags_of_both_detectors(spark, sf):
    t = Tables(spark, sf)
    rows = anomalies.plane(t)
    alone = {r.id for r in QUERIES["ml_isolation_forest"](spark, sf).filter("outlier_5").collect()}
    sparse = {r.id for r in QUERIES["ml_lof"](spark, sf).filter("outlier").collect()}
    out = {r.grp: r for r in QUERIES["ml_anomaly_consensus"](spark, sf).collect()}
    for grp, ids in rows.groupBy("grp").agg(F.collect_list("id")).collect():
        ids, r = set(ids), out[grp]
        assert (r.n, r.isolated, r.sparse) == (len(ids), len(ids & alone), len(ids & sparse))
        assert (r.either, r.both) == (len(ids & (alone | sparse)), len(ids & alone & sparse))
    assert sum(r.both for r in out.values()) > 0


def test_sampled_contributions_come_with_their_error(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    y = ((x[:, 0] + 0.5 * x[:, 1]) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, y int")
    model = mo.fit(df, mo.feature_stages(list("abc")), mo.logistic("y"))
    few, many = (mo.mean_absolute(mo.sampled_shapley(model, df, list("abc"), "id", orders)).toPandas().set_index("feature") for orders in (4, 24))
    assert list(many.index[:2]) == ["a", "b"] and (many["std_error"] < few["std_error"]).all()
