"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
SQL = entry_point.oracle_sql()

# Sequential recursions and searches run in Python, one task per series or leaf.
SEQUENTIAL = {
    "join_knn_topk", "join_knn_repeated", "ml_lof", "ml_smote", "bayes_beta_interval", "ts_pacf", "viz_kde", "viz_violin", "win_changepoint_peaks",
}
# Here a tail probability or a small system is solved on result rows, one per test or group.
RESULT_ROWS = {
    "bayes_density_grid", "stat_t_welch", "stat_mannwhitney", "causal_psm", "stat_chi2", "stat_cramers_v", "stat_t_pooled", "stat_anova", "stat_kruskal",
    "stat_ks2", "stat_benford", "stat_regime_chi2", "stat_pairwise_t", "surv_logrank", "ml_select_kbest", "ts_arima", "ts_adf", "ts_coint",
}
PYTHON = SEQUENTIAL | RESULT_ROWS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in SQL if k not in PYTHON and not k.startswith(("src_", "sink_"))))
def test_no_cartesian_and_no_python(spark, sf, key):
    plan = plan_of(QUERIES[key](spark, sf))
    assert "CartesianProduct" not in plan
    for node in ("BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert node not in plan


@pytest.mark.parametrize("key", sorted(RESULT_ROWS))
def test_python_sees_sums_only(spark, sf, key):
    """No Python node reads rows of a table: each stands above an aggregate."""
    plan = plan_of(QUERIES[key](spark, sf))
    assert "CartesianProduct" not in plan
    for node in ("ArrowEvalPython", "MapInPandas"):
        if node in plan:
            assert "Aggregate" in plan[plan.index(node):]


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = QUERIES["filter_date_range"](spark, sf)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual" in plan
    narrow = QUERIES["agg_value_counts"](spark, sf)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<p_type:string>" in narrow


def test_rank_filter_is_applied_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan_of(QUERIES["topk_per_group"](spark, sf))
