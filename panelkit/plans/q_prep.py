"""Phase 3 queries: audits, differencing, decomposition, outliers, interpolation, split."""

from __future__ import annotations

from itertools import combinations

from panelkit.operators import panel as P
from panelkit.operators import prep as R
from panelkit.operators import quality as Q
from panelkit.plans import oracles_model as OM
from panelkit.plans.fixtures import SERIES, with_ctes
from panelkit.plans.q_panel import PANEL_BASE_CTES, panel_body, stored_panel
from panelkit.plans.registry import register, round_doubles
from panelkit.session import materialize

K = [SERIES]
Y = P.OUTCOME
X = P.EXOGENOUS


def frame(spark, sf):
    """Panel-grain modelling frame, checkpointed once: every branch downstream
    (statistics joined back, phase means, PCA, grid) reads it instead of
    re-scanning and re-aggregating the raw events."""
    return materialize(R.model_frame(stored_panel(spark, sf), X, Y, K))


def blanked(spark, sf):
    return R.outlier_blank(frame(spark, sf), Y, X, K)


def interpolated(spark, sf, leading="null"):
    return R.interpolate_cubic(blanked(spark, sf), X, K, leading=leading)


# ------------------------------------------------------------------ SQL side
MF_CTES = [*PANEL_BASE_CTES, "panel AS (\n" + panel_body(True, rounded=False) + ")",
           "mf AS (SELECT series_key, week_start, "
           "CAST(row_number() OVER (PARTITION BY series_key ORDER BY week_start) - 1 AS INTEGER) AS t_idx, "
           + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in X)
           + f", CAST({Y} AS DOUBLE) AS {Y} FROM panel)"]
MASK = "COALESCE(abs(m.{y} - s._med) > 3 * s._sd, false)".format(y=Y)
OB_CTES = [*MF_CTES,
           f"stats AS (SELECT series_key, median({Y}) AS _med, stddev_samp({Y}) AS _sd FROM mf GROUP BY series_key)",
           "ob AS (SELECT m.series_key, m.week_start, m.t_idx, "
           + ", ".join(f"CASE WHEN {MASK} THEN NULL ELSE m.{c} END AS {c}" for c in X)
           + f", COALESCE(CASE WHEN {MASK} THEN NULL ELSE m.{Y} END, s._med) AS {Y}, {MASK} AS is_outlier "
           "FROM mf m JOIN stats s ON s.series_key = m.series_key)"]

BW = "(PARTITION BY series_key ORDER BY t_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
FW = "(PARTITION BY series_key ORDER BY t_idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"


def _lagrange_sql(t, pts):
    terms = []
    for i, (xi, yi) in enumerate(pts):
        term = yi
        for j, (xj, _) in enumerate(pts):
            if i != j:
                term = f"({term}) * ({t} - {xj}) / ({xi} - {xj})"
        terms.append(f"({term})")
    total = terms[0]
    for tm in terms[1:]:
        total = f"({total} + {tm})"
    return total


def interp_ctes(leading="null"):
    i1 = "i1 AS (SELECT *, (week_start - DATE '1970-01-04') / 7.0 AS _x FROM ob)"
    p1 = []
    for c in X:
        p1 += [f"last_value(CASE WHEN {c} IS NOT NULL THEN _x END IGNORE NULLS) OVER {BW} AS _p_{c}_x",
               f"last_value({c} IGNORE NULLS) OVER {BW} AS _p_{c}_y",
               f"first_value(CASE WHEN {c} IS NOT NULL THEN _x END IGNORE NULLS) OVER {FW} AS _n_{c}_x",
               f"first_value({c} IGNORE NULLS) OVER {FW} AS _n_{c}_y"]
    i2 = "i2 AS (SELECT *, " + ", ".join(p1) + " FROM i1)"
    p2 = []
    for c in X:
        for a in ("x", "y"):
            p2 += [f"last_value(CASE WHEN {c} IS NOT NULL THEN _p_{c}_{a} END IGNORE NULLS) OVER {BW} AS _pp_{c}_{a}",
                   f"first_value(CASE WHEN {c} IS NOT NULL THEN _n_{c}_{a} END IGNORE NULLS) OVER {FW} AS _nn_{c}_{a}"]
    i3 = "i3 AS (SELECT *, " + ", ".join(p2) + " FROM i2)"
    outs = []
    for c in X:
        p, n, pp, nn = (f"_p_{c}", f"_n_{c}", f"_pp_{c}", f"_nn_{c}")
        cubic = _lagrange_sql("_x", [(f"{pp}_x", f"{pp}_y"), (f"{p}_x", f"{p}_y"),
                                     (f"{n}_x", f"{n}_y"), (f"{nn}_x", f"{nn}_y")])
        linear = f"({p}_y + ({n}_y - {p}_y) * (_x - {p}_x) / ({n}_x - {p}_x))"
        tail = f"CASE WHEN {pp}_x IS NOT NULL THEN {p}_y + ({p}_y - {pp}_y) * (_x - {p}_x) / ({p}_x - {pp}_x) ELSE {p}_y END"
        e = (f"CASE WHEN {c} IS NOT NULL THEN {c} "
             f"WHEN {p}_x IS NOT NULL AND {n}_x IS NOT NULL THEN "
             f"(CASE WHEN {pp}_x IS NOT NULL AND {nn}_x IS NOT NULL THEN {cubic} ELSE {linear} END) "
             f"WHEN {p}_x IS NOT NULL THEN {tail} END")
        if leading == "hold":
            e = f"COALESCE({e}, {n}_y)"
        outs.append(f"{e} AS {c}")
    ip = f"ip AS (SELECT series_key, week_start, t_idx, {', '.join(outs)}, {Y}, is_outlier FROM i3)"
    return [i1, i2, i3, ip]


def r6(e):
    return f"round({e}, 6)"


# ------------------------------------------------------------------ queries
NULL_COLS = [*X, Y]


@register("null_audit", with_ctes(*MF_CTES) + "SELECT series_key, COUNT(*) AS n_rows, "
          + "count(*) FILTER (WHERE " + " OR ".join(f"{c} IS NULL" for c in NULL_COLS) + ") AS n_null_rows, "
          + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in NULL_COLS)
          + " FROM mf GROUP BY series_key", covers="A11 F6 A15")
def q_null_audit(spark, sf):
    return Q.null_audit(frame(spark, sf), NULL_COLS, K)


@register("gap_report", with_ctes(*MF_CTES) + """SELECT series_key, COUNT(*) AS n_weeks, min(week_start) AS first_week,
  max(week_start) AS last_week, CAST((max(week_start) - min(week_start)) / 7 + 1 AS BIGINT) AS expected_weeks,
  CAST((max(week_start) - min(week_start)) / 7 + 1 AS BIGINT) - COUNT(*) AS missing_weeks
FROM mf GROUP BY series_key""", covers="gap_report")
def q_gap_report(spark, sf):
    return Q.gap_report(frame(spark, sf), K)


PAIRS = list(combinations(X, 2))
CORR_SQL = (with_ctes(*MF_CTES) + "SELECT series_key, s.var_x AS var_x, s.var_y AS var_y, round(s.corr, 6) AS corr FROM ("
            "SELECT series_key, unnest([" + ", ".join(
                f"{{'var_x': '{a}', 'var_y': '{b}', 'corr': corr({a}, {b})}}" for a, b in PAIRS)
            + "]) AS s FROM mf GROUP BY series_key) q")


@register("corr_matrix", CORR_SQL, covers="A9 M6")
def q_corr_matrix(spark, sf):
    return round_doubles(Q.corr_matrix(frame(spark, sf), X, K))


@register("collinear_pairs", CORR_SQL + " WHERE abs(s.corr) > 0.8", covers="A10 M6")
def q_collinear_pairs(spark, sf):
    return round_doubles(Q.collinear_pairs(Q.corr_matrix(frame(spark, sf), X, K), 0.8))


@register("difference", with_ctes(*MF_CTES) + f"""SELECT series_key, week_start, t_idx, {Y},
  {Y} - lag({Y}, 1) OVER (PARTITION BY series_key ORDER BY t_idx) AS {Y}_diff FROM mf""", covers="P7")
def q_difference(spark, sf):
    return round_doubles(R.difference(frame(spark, sf), Y, K).select(SERIES, "week_start", R.T, Y, f"{Y}_diff"))


DECOMP_SQL = with_ctes(*MF_CTES, f"""d AS (SELECT series_key, week_start, t_idx, {Y},
  CASE WHEN count({Y}) OVER (PARTITION BY series_key ORDER BY t_idx ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING) = 53
       THEN (sum({Y}) OVER (PARTITION BY series_key ORDER BY t_idx ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING)
             - 0.5 * lag({Y}, 26) OVER (PARTITION BY series_key ORDER BY t_idx)
             - 0.5 * lead({Y}, 26) OVER (PARTITION BY series_key ORDER BY t_idx)) / 52 END AS trend,
  t_idx % 52 AS _phase FROM mf)""", f"""ph AS (SELECT series_key, _phase, avg({Y} - trend) AS _pm FROM d GROUP BY 1, 2)""",
                       """ph2 AS (SELECT series_key, _phase, _pm - avg(_pm) OVER (PARTITION BY series_key) AS seasonal FROM ph)""") + \
    f"""SELECT d.series_key, d.week_start, d.t_idx, round(d.{Y}, 6) AS {Y}, round(d.trend, 6) AS trend,
  round(p.seasonal, 6) AS seasonal, round(d.{Y} - d.trend - p.seasonal, 6) AS resid
FROM d LEFT JOIN ph2 p ON p.series_key = d.series_key AND p._phase = d._phase"""


@register("decompose", DECOMP_SQL, covers="P8 P9 P10")
def q_decompose(spark, sf):
    d = R.decompose(frame(spark, sf), Y, K, period=52)
    return round_doubles(d.select(SERIES, "week_start", R.T, Y, "trend", "seasonal", "resid"))


@register("outlier_blank", with_ctes(*OB_CTES) + "SELECT series_key, week_start, t_idx, "
          + ", ".join(r6(c) + f" AS {c}" for c in [*X, Y]) + ", is_outlier FROM ob", covers="P11 A7 A8 X6")
def q_outlier_blank(spark, sf):
    return round_doubles(blanked(spark, sf))


@register("interpolate_cubic", with_ctes(*OB_CTES, *interp_ctes()) + "SELECT series_key, week_start, t_idx, "
          + ", ".join(r6(c) + f" AS {c}" for c in [*X, Y]) + ", is_outlier FROM ip", covers="P12 P6")
def q_interpolate_cubic(spark, sf):
    return round_doubles(interpolated(spark, sf))


@register("chrono_split", with_ctes(*MF_CTES) + """SELECT series_key, week_start, t_idx,
  CAST(round_even(0.8 * count(*) OVER (PARTITION BY series_key), 0) AS INTEGER) AS n_train,
  CASE WHEN t_idx < round_even(0.8 * count(*) OVER (PARTITION BY series_key), 0) THEN 'train' ELSE 'test' END AS split
FROM mf""", covers="P13 X7 O3 A15")
def q_chrono_split(spark, sf):
    return R.chrono_split(frame(spark, sf).select(SERIES, "week_start", R.T), K)


@register("interpolate_spline", OM.recursive(with_ctes(*OB_CTES, *OM.spline_ctes(X))) + OM.spline_select(X, Y),
          covers="P12(spline)")
def q_interpolate_spline(spark, sf):
    return round_doubles(R.interpolate_spline(blanked(spark, sf), X, K))
