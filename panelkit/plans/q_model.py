"""Phase 5 queries: ACF/PACF, ADF, candidate grid, seasonal fits, selection, forecasts, run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import prep as R
from panelkit.operators import seasonal as SE
from panelkit.operators import tsstats as TS
from panelkit.plans import oracles_model as OM
from panelkit.plans.fixtures import FX_EVENTS_SQL, RUN_TS, SERIES, with_ctes
from panelkit.plans.q_panel import events_sorted
from panelkit.plans.q_multi import FEATURES, N_COMPONENTS, Z_CTES, scores
from panelkit.plans.q_prep import MF_CTES, Y, frame
from panelkit.plans.registry import register, round_doubles
from panelkit.session import materialize, work_dir

K = [SERIES]
#: Lags that the oracle's text spells out; each series reads 10 log10(n) of them, n under 10 million.
ORACLE_LAGS = 70
PCS = [f"PC{i}" for i in range(1, N_COMPONENTS + 1)]
DIFF = f"{Y}_diff"


def diffed(spark, sf):
    return R.difference(frame(spark, sf), Y, K, out=DIFF)


def model_frame(spark, sf):
    """PC scores + outcome + 80/20 split, checkpointed (panel grain, reused by every pass)."""
    sc = scores(spark, sf).select(SERIES, "week_start", "t_idx", *PCS, Y)
    return materialize(R.chrono_split(sc, K))


def grid(spark, sf, mf=None):
    mf = mf if mf is not None else model_frame(spark, sf)
    return materialize(SE.seasonal_arx_grid(mf.where(F.col("split") == "train"), Y, PCS, K))


DX_CTE = f"dx AS (SELECT series_key, t_idx, {Y} - lag({Y}) OVER (PARTITION BY series_key ORDER BY t_idx) AS v FROM mf)"
ACF_CTES = [*MF_CTES, DX_CTE,
            """x AS (SELECT series_key, v, row_number() OVER (PARTITION BY series_key ORDER BY t_idx) - 1 AS _t FROM dx WHERE v IS NOT NULL)""",
            """c AS (SELECT series_key, _t, v - avg(v) OVER (PARTITION BY series_key) AS c FROM x)""",
            "l AS (SELECT series_key, c, " + ", ".join(
                f"lag(c, {k}) OVER (PARTITION BY series_key ORDER BY _t) AS l{k}" for k in range(1, ORACLE_LAGS + 1))
            + " FROM c)",
            "s AS (SELECT series_key, count(*) AS n, sum(c * c) AS s0, " + ", ".join(
                f"sum(c * l{k}) AS s{k}" for k in range(1, ORACLE_LAGS + 1)) + " FROM l GROUP BY series_key)",
            "ac AS (SELECT series_key, CAST(u.lag AS INTEGER) AS lag, u.acf AS acf, 1.96 / sqrt(n) AS conf "
            "FROM (SELECT series_key, n, unnest([" + ", ".join(
                f"{{'lag': {k}, 'acf': s{k} / s0}}" for k in range(1, ORACLE_LAGS + 1)) + "]) AS u FROM s) q "
            "WHERE u.lag <= least(floor(10 * log10(n)), n // 2 - 1))"]
ACF_SQL = with_ctes(*ACF_CTES) + "SELECT series_key, lag, round(acf, 6) AS acf, round(conf, 6) AS conf FROM ac"


@register("acf", ACF_SQL, covers="M7 F7")
def q_acf(spark, sf):
    return round_doubles(TS.acf(diffed(spark, sf), DIFF, keys=K))


@register("pacf", OM.recursive(with_ctes(*ACF_CTES, *OM.PACF_CTES)) + OM.PACF_SELECT, covers="M7")
def q_pacf(spark, sf):
    return round_doubles(TS.pacf(TS.acf(diffed(spark, sf), DIFF, keys=K), K))


@register("adf", OM.recursive(with_ctes(*MF_CTES, DX_CTE, *OM.ADF_CTES)) + OM.ADF_SELECT, covers="M8")
def q_adf(spark, sf):
    return round_doubles(TS.adf(diffed(spark, sf), DIFF, K))


@register("candidate_grid", with_ctes(FX_EVENTS_SQL) + """SELECT series_key, CAST(i AS INTEGER) AS grid_pos,
  CAST((i // 32) % 2 AS INTEGER) AS p, CAST((i // 16) % 2 AS INTEGER) AS d, CAST((i // 8) % 2 AS INTEGER) AS q,
  CAST((i // 4) % 2 AS INTEGER) AS sp, CAST((i // 2) % 2 AS INTEGER) AS sd, CAST(i % 2 AS INTEGER) AS sq,
  52 AS s
FROM (SELECT series_key, unnest(range(64)) AS i FROM (SELECT DISTINCT series_key FROM fx_events) k) g""",
          covers="M9 J7")
def q_candidate_grid(spark, sf):
    series = events_sorted(spark, sf).select(SERIES).distinct()
    return SE.candidate_grid(spark, series=series, keys=K)


GRID_WITH = OM.recursive(with_ctes(*Z_CTES, *OM.pca_ctes(FEATURES), *OM.grid_ctes(FEATURES, N_COMPONENTS, Y)))


@register("seasonal_arx_grid", GRID_WITH + OM.GRID_SELECT, covers="M10")
def q_seasonal_arx_grid(spark, sf):
    """All candidates; the residual variance, millions here, to 2 digits (a double holds 15 to 16 in all)."""
    g = grid(spark, sf)
    return round_doubles(g.select(SERIES, "grid_pos", "p", "d", "q", "sp", "sd", "sq", "s", "aic",
                                  F.round("sigma2", 2).alias("sigma2"),
                                  "n_eff", "stationary", "invertible", "error"))


@register("best_model", GRID_WITH + OM.BEST_SELECT, covers="M11 A14")
def q_best_model(spark, sf):
    b = SE.best_model(grid(spark, sf), K)
    return round_doubles(b.select(SERIES, "grid_pos", "p", "d", "q", "sp", "sd", "sq", "s", "aic"))


@register("coef_table", GRID_WITH + OM.coef_select(N_COMPONENTS), covers="M12")
def q_coef_table(spark, sf):
    return round_doubles(SE.coef_table(SE.best_model(grid(spark, sf), K), PCS, K))


def _forecast(spark, sf):
    mf = model_frame(spark, sf)
    best = SE.best_model(grid(spark, sf, mf), K)
    return mf, best, SE.forecast(mf, best, Y, PCS, K)


#: Forecasts and errors, thousands here after recursions over hundreds of weeks, are compared to 3 digits.
DIGITS = 3
RUN_ID = "run-" + RUN_TS.replace(" ", "T")
FORECAST_WITH = OM.recursive(with_ctes(*Z_CTES, *OM.pca_ctes(FEATURES), *OM.grid_ctes(FEATURES, N_COMPONENTS, Y),
                                       *OM.forecast_ctes(N_COMPONENTS), OM.METRICS))


@register("forecast", FORECAST_WITH + OM.forecast_select(DIGITS).replace("{run_ts}", RUN_TS), covers="M14 M15 M16 S13 P4")
def q_forecast(spark, sf):
    """Forecast the test span and append it, partitioned by load date; read the table back."""
    _, _, fc = _forecast(spark, sf)
    out = fc.select(SERIES, "week_start", F.col("predicted").alias("predicted_orders"),
                    "ci_lo", "ci_hi", F.to_date(F.lit(RUN_TS)).alias("load_dt"))
    path = work_dir(spark, "predicted")
    out.write.mode("append").partitionBy("load_dt").parquet(path)
    return round_doubles(spark.read.parquet(path), DIGITS)


@register("forecast_vs_observed", FORECAST_WITH + OM.observed_select(DIGITS), covers="J6 M17")
def q_forecast_vs_observed(spark, sf):
    mf, _, fc = _forecast(spark, sf)
    out = SE.forecast_vs_observed(fc, mf, Y, K)
    return out.select(*[F.round(c, 5 if c == "mape" else DIGITS).alias(c) if kind == "double" else F.col(c)
                        for c, kind in out.dtypes])


@register("run_log", FORECAST_WITH + OM.log_select(RUN_ID, RUN_TS, DIGITS), covers="M13")
def q_run_log(spark, sf):
    """Append the selected model's parameters and metrics to a runs table
    (partitioned by run day) and read it back, each parameter and metric as a column."""
    mf, best, fc = _forecast(spark, sf)
    log = SE.run_log(best, RUN_ID, RUN_TS, K, SE.forecast_vs_observed(fc, mf, Y, K))
    path = work_dir(spark, "runs")
    log.withColumn("run_day", F.to_date("run_ts")).write.mode("append").partitionBy("run_day").parquet(path)
    params, metrics = F.col("params"), F.col("metrics")
    return spark.read.parquet(path).select(
        SERIES, "run_id", "run_ts", params["order"].alias("order"), params["seasonal_order"].alias("seasonal_order"),
        F.round(metrics["AIC"], 6).alias("aic"), F.round(metrics["rmse"], DIGITS).alias("rmse"),
        F.round(metrics["mape"], 5).alias("mape"))
