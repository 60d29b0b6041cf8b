"""The studied pipeline models one series: every operator must work without keys,
and no step may plan a cartesian product or nested-loop join."""

from pyspark.sql import functions as F

from panelkit.operators import multivar as M
from panelkit.operators import panel as P
from panelkit.operators import prep as R
from panelkit.operators import seasonal as SE
from panelkit.operators import tsstats as TS
from panelkit.plans import fixtures as FX
from panelkit.plans.q_panel import indicators_sorted, polls_sorted


def _clean(plan_df):
    p = plan_df._jdf.queryExecution().executedPlan().toString()
    return "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_single_series_chain(spark, sf):
    ev = FX.fx_events(spark, sf)
    panel = P.weekly_panel(ev, polls_sorted(spark, sf), indicators_sorted(spark, sf), FX.AS_OF, FX.RUN_TS)
    assert _clean(panel)
    n_weeks = panel.count()
    assert n_weeks > 300
    f = R.model_frame(panel, P.EXOGENOUS, P.OUTCOME)
    b = R.outlier_blank(f, P.OUTCOME, P.EXOGENOUS)
    ip = R.interpolate_cubic(b, P.EXOGENOUS, leading="hold")
    feats = [c for c in P.EXOGENOUS if c != "disapproving"]
    z = M.standardize(ip.select("week_start", "t_idx", *feats, P.OUTCOME), feats)
    model = M.pca_model(z, feats)
    sc = M.pca_scores(z, model, feats, 4)
    assert _clean(sc) and sc.count() == n_weeks
    mf = R.chrono_split(sc.select("week_start", "t_idx", "PC1", "PC2", "PC3", "PC4", P.OUTCOME))
    grid = SE.seasonal_arx_grid(mf.where(F.col("split") == "train"), P.OUTCOME, ["PC1", "PC2", "PC3", "PC4"])
    assert grid.count() == 64
    best = SE.best_model(grid)
    fc = SE.forecast(mf, best, P.OUTCOME, ["PC1", "PC2", "PC3", "PC4"])
    assert _clean(fc)
    n_test = mf.where(F.col("split") == "test").count()
    assert fc.count() == n_test
    log = SE.run_log(best, "r1", FX.RUN_TS, metrics=SE.forecast_vs_observed(fc, mf, P.OUTCOME))
    row = log.first()
    assert set(row.metrics) == {"AIC", "rmse", "mape"} and _clean(log)
    diffd = R.difference(f, P.OUTCOME, dropna=True)
    assert TS.adf(diffd, f"{P.OUTCOME}_diff").count() == 1
    assert TS.pacf(TS.acf(diffd, f"{P.OUTCOME}_diff", 10)).count() == 10
