"""Phase 4 queries: standardisation, PCA, scree, component choice, PC/outcome join."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.constants import PCA_COMPONENTS
from panelkit.operators import multivar as M
from panelkit.plans import oracles_model as OM
from panelkit.plans.fixtures import SERIES, with_ctes
from panelkit.plans.q_prep import OB_CTES, X, Y, interp_ctes, interpolated
from panelkit.plans.registry import register, round_doubles
from panelkit.session import materialize

K = [SERIES]
# Exogenous features for PCA: all but the collinear 'disapproving' (16 columns).
FEATURES = [c for c in X if c != "disapproving"]
N_COMPONENTS = PCA_COMPONENTS


def standardized(spark, sf, checkpoint=False):
    ip = interpolated(spark, sf, leading="hold")
    z = M.standardize(ip.select(SERIES, "week_start", "t_idx", *FEATURES, Y), FEATURES, K)
    return materialize(z) if checkpoint else z


def model(spark, sf, z=None):
    return M.pca_model(z if z is not None else standardized(spark, sf), FEATURES, K)


def scores(spark, sf, k=N_COMPONENTS):
    """PC scores plus the outcome; the standardised frame is checkpointed once
    and feeds both the model fit and the projection."""
    z = standardized(spark, sf, checkpoint=True)
    return M.pca_scores(z, model(spark, sf, z), FEATURES, k, K)


Z_CTES = [*OB_CTES, *interp_ctes("hold"), "st AS (SELECT series_key, " + ", ".join(
    f"avg({c}) AS _m_{c}, stddev_pop({c}) AS _s_{c}" for c in FEATURES) + " FROM ip GROUP BY series_key)",
    f"z AS (SELECT ip.series_key, ip.week_start, ip.t_idx, ip.{Y}, " + ", ".join(
        f"CASE WHEN st._s_{c} = 0 THEN 0.0 ELSE (ip.{c} - st._m_{c}) / st._s_{c} END AS {c}"
        for c in FEATURES) + " FROM ip JOIN st ON st.series_key = ip.series_key)"]
STD_SQL = with_ctes(*Z_CTES) + "SELECT series_key, week_start, t_idx, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in [Y, *FEATURES]) + " FROM z"
PCA_WITH = OM.recursive(with_ctes(*Z_CTES, *OM.pca_ctes(FEATURES)))


@register("standardize", STD_SQL, covers="M1 P2 P6")
def q_standardize(spark, sf):
    return round_doubles(standardized(spark, sf))


@register("pca_loadings", PCA_WITH + OM.loadings_select(FEATURES), covers="M3 M2")
def q_pca_loadings(spark, sf):
    return round_doubles(model(spark, sf))


@register("pca_scores", PCA_WITH + OM.scores_select(FEATURES, N_COMPONENTS), covers="M2")
def q_pca_scores(spark, sf):
    return round_doubles(scores(spark, sf).select(SERIES, "week_start", "t_idx",
                                                  *[f"PC{i}" for i in range(1, N_COMPONENTS + 1)]))


@register("scree", PCA_WITH + OM.SCREE_SELECT, covers="M4 P14")
def q_scree(spark, sf):
    return round_doubles(M.scree(model(spark, sf), K))


@register("choose_k", PCA_WITH + OM.CHOOSE_K_SELECT, covers="M5")
def q_choose_k(spark, sf):
    return M.choose_k(M.scree(model(spark, sf), K), keys=K)


@register("pc_outcome_join", PCA_WITH + OM.scores_select(FEATURES, N_COMPONENTS, f", round(z.{Y}, 6) AS {Y}"),
          covers="J5")
def q_pc_outcome_join(spark, sf):
    sc = scores(spark, sf)
    s = sc.select(SERIES, "week_start", "t_idx", *[f"PC{i}" for i in range(1, N_COMPONENTS + 1)])
    y = sc.select(SERIES, "week_start", F.col(Y))
    return round_doubles(s.join(y, [SERIES, "week_start"], "left"))
