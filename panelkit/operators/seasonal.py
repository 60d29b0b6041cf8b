"""Seasonal regression-with-ARMA-errors grid search, selection, coefficients, forecasts.

Re-aimed from a per-candidate maximum-likelihood state-space fit to
conditional least squares in three Spark passes per ``(series, d, D)``:

0. difference ``y`` and the regressors with ``(1-B)^d (1-B^s)^D`` (windows),
   aggregate the Gram matrix of ``[X, w]`` -> regression ``beta`` -> error ``u``;
1. long autoregression of ``u`` on lags ``1..L1, s, s+1`` -> innovations ``e``
   (Hannan-Rissanen);
2. one Gram matrix of ``[u_1, u_s, u_{s+1}, e_1, e_s, e_{s+1}, u]`` on a common
   sample; each of the 16 ``(p, q, P, Q)`` candidates solves its sub-system.

All row work (lags, products, sums) is Spark; a grouped-map function only
sees one Gram row per ``(series, d, D)`` (tens of numbers). Coefficients are
not maximum-likelihood values; the lag ``s+1`` terms are free rather than the
product of the seasonal and non-seasonal ones.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.constants import CONFIDENCE_Z, ORDER_VALUES, SEASON
from panelkit.operators.multivar import attach

T = "t_idx"
LONG_AR = 8
DD = [(d, D) for d in ORDER_VALUES for D in ORDER_VALUES]  # (d, D) differencing pairs


def candidate_grid(spark: SparkSession, s: int = SEASON, series: DataFrame | None = None,
                   keys: Sequence[str] = ()) -> DataFrame:
    """All ``(p,d,q) x (P,D,Q,s)`` with each order in {0, 1}: 64 rows in loop order.

    With ``series`` (one row per series key), every series emits its own 64
    candidates (``explode``), so the grid is built in parallel per series.
    """
    keys = list(keys)
    if series is None:
        g = spark.range(64).select(F.col("id").cast("int").alias("grid_pos"))
    else:
        g = series.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(63))).alias("grid_pos"))
    bit = lambda k: ((F.col("grid_pos") / (2 ** k)).cast("int") % 2).cast("int")
    return g.select(*keys, "grid_pos", bit(5).alias("p"), bit(4).alias("d"), bit(3).alias("q"),
                    bit(2).alias("sp"), bit(1).alias("sd"), bit(0).alias("sq"), F.lit(s).alias("s"))


def _keys_schema(df: DataFrame, keys: Sequence[str]) -> str:
    fields = [f for f in df.schema.fields if f.name in keys]
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + (", " if fields else "")


def _gram(df: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    m = len(cols)
    ok = F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in cols))
    return (df.where(ok).groupBy(*group)
            .agg(F.count(F.lit(1)).alias("n"),
                 *[F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"g_{i}_{j}") for i in range(m) for j in range(i, m)]))


def _G(row, m: int) -> np.ndarray:
    G = np.zeros((m, m))
    for i in range(m):
        for j in range(i, m):
            G[i, j] = G[j, i] = row[f"g_{i}_{j}"]
    return G


def _ols(G, idx, tgt):
    Z = G[np.ix_(idx, idx)]
    zy = G[idx, tgt]
    inv = np.linalg.pinv(Z)
    b = inv @ zy
    ssr = float(G[tgt, tgt] - b @ zy)
    return b, max(ssr, 1e-300), inv


def _coef_pass(gram: DataFrame, group: list[str], m: int, names: list[str]) -> DataFrame:
    """Solve target (last column) on all other columns per group; coefficients + std errors."""
    schema = _keys_schema(gram, group) + ", ".join(
        [f"{n} double" for n in names] + [f"se_{n} double" for n in names] + ["sigma2 double", "n_obs long"])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        out = {k: row[k] for k in group}
        n = float(row["n"])
        k = len(names)
        if n <= k:
            out.update({c: None for c in names}, **{f"se_{c}": None for c in names}, sigma2=None, n_obs=int(n))
            return pd.DataFrame([out])
        b, ssr, inv = _ols(_G(row, m), list(range(k)), m - 1)
        s2 = ssr / (n - k)
        out.update({c: float(v) for c, v in zip(names, b)})
        out.update({f"se_{c}": float(math.sqrt(max(s2 * inv[i, i], 0.0))) for i, c in enumerate(names)})
        out.update(sigma2=float(s2), n_obs=int(n))
        return pd.DataFrame([out])

    return gram.groupBy(*group).applyInPandas(solve, schema)


def _differenced(frame: DataFrame, y: str, xcols: list[str], keys: list[str], s: int) -> DataFrame:
    """Four copies (d, D) of each train row with ``w = (1-B)^d (1-B^s)^D v`` for y and X."""
    x = frame.select(*keys, T, y, *xcols, F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(D).alias("sd"))
                                                                for d, D in DD])).alias("_dd"))
    x = x.select(*keys, T, y, *xcols, F.col("_dd.d").alias("d"), F.col("_dd.sd").alias("sd"))
    w = Window.partitionBy(*keys, "d", "sd").orderBy(T)

    def diff(c):
        v = F.col(c)
        t1 = F.when(F.col("d") == 1, F.lag(v, 1).over(w)).otherwise(F.lit(0.0))
        ts = F.when(F.col("sd") == 1, F.lag(v, s).over(w)).otherwise(F.lit(0.0))
        ts1 = F.when((F.col("d") == 1) & (F.col("sd") == 1), F.lag(v, s + 1).over(w)).otherwise(F.lit(0.0))
        return v - t1 - ts + ts1

    return x.select(*keys, "d", "sd", T, *[diff(c).alias(f"w_{c}") for c in [*xcols, y]])


def arx_passes(train: DataFrame, y: str, xcols: Sequence[str], keys: Sequence[str] = (), s: int = SEASON,
               long_ar: int = LONG_AR):
    """Stages 0-2; returns (beta table, stage-2 Gram table, ar-lag names)."""
    keys, xcols = list(keys), list(xcols)
    grp = [*keys, "d", "sd"]
    dw = _differenced(train, y, xcols, keys, s)
    # stage 0: w ~ X (no intercept)
    g0 = _gram(dw, grp, [f"w_{c}" for c in xcols] + [f"w_{y}"])
    beta = _coef_pass(g0, grp, len(xcols) + 1, [f"b_{c}" for c in xcols])
    u = dw.join(beta.select(*grp, *[f"b_{c}" for c in xcols]), grp, "left")
    fit = F.lit(0.0)
    for c in xcols:
        fit = fit + F.col(f"w_{c}") * F.col(f"b_{c}")
    u = u.select(*grp, T, (F.col(f"w_{y}") - fit).alias("u"))
    w = Window.partitionBy(*grp).orderBy(T)
    # stage 1: long AR of u -> innovations e
    ar_lags = [*range(1, long_ar + 1), s, s + 1]
    ul = u.select("*", *[F.lag("u", k).over(w).alias(f"u_l{k}") for k in ar_lags])
    g1 = _gram(ul, grp, [f"u_l{k}" for k in ar_lags] + ["u"])
    a1 = _coef_pass(g1, grp, len(ar_lags) + 1, [f"a_{k}" for k in ar_lags])
    e = ul.join(a1.select(*grp, *[f"a_{k}" for k in ar_lags]), grp, "left")
    pred = F.lit(0.0)
    for k in ar_lags:
        pred = pred + F.col(f"u_l{k}") * F.col(f"a_{k}")
    e = e.select(*grp, T, "u", (F.col("u") - pred).alias("e"))
    # stage 2: one Gram for all 16 (p, q, P, Q) candidates
    lagcols = []
    for nm, k in (("u", 1), ("u", s), ("u", s + 1), ("e", 1), ("e", s), ("e", s + 1)):
        lagcols.append(F.lag(nm, k).over(w).alias(f"{nm}{k}"))
    z = e.select(*grp, T, "u", *lagcols)
    names = ["u1", f"u{s}", f"u{s + 1}", "e1", f"e{s}", f"e{s + 1}"]
    # one sample for all candidates of a series: the weeks usable under every differencing that
    # leaves more weeks than unknowns, else the AICs would be taken on different numbers of rows
    usable = F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in [*names, "u"]))
    z = z.where(usable).withColumn("_own", F.count(F.lit(1)).over(Window.partitionBy(*grp)))
    z = z.where(F.col("_own") > len(names) + len(xcols) + 1)
    z = z.withColumn("_pairs", F.size(F.collect_set(F.struct("d", "sd")).over(Window.partitionBy(*keys))))
    z = z.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys, T))).where("_n = _pairs")
    g2 = _gram(z, grp, [*names, "u"])
    # a pair without a usable week still gets its row
    g2 = attach(dw.select(*grp).distinct(), g2, grp, "left")
    return beta, g2, names


def _roots_ok(coefs: dict, lags: dict, sign: float) -> bool:
    """Roots of 1 + sign*sum c_k B^k outside the unit circle."""
    if not coefs:
        return True
    deg = max(lags[n] for n in coefs)
    poly = np.zeros(deg + 1)
    poly[0] = 1.0
    for n, c in coefs.items():
        poly[lags[n]] += sign * c
    r = np.roots(poly[::-1])
    return bool(np.all(np.abs(r) > 1.0 + 1e-9))


def seasonal_arx_grid(train: DataFrame, y: str, xcols: Sequence[str], keys: Sequence[str] = (),
                      s: int = SEASON) -> DataFrame:
    """Fit all 64 candidates per series on one common sample; one row per candidate with AIC or an error.

    A candidate can't be fitted if it has no more rows than unknowns, a singular
    Gram matrix, or no residual variance.
    """
    keys, xcols = list(keys), list(xcols)
    beta, g2, names = arx_passes(train, y, xcols, keys, s)
    grp = [*keys, "d", "sd"]
    lag_of = {"u1": 1, f"u{s}": s, f"u{s + 1}": s + 1, "e1": 1, f"e{s}": s, f"e{s + 1}": s + 1}
    kx = len(xcols)
    schema = _keys_schema(g2, keys) + ("grid_pos int, p int, d int, q int, sp int, sd int, sq int, s int, "
                                       "aic double, sigma2 double, n_eff long, stationary boolean, "
                                       "invertible boolean, error string, coefs map<string,double>, "
                                       "std_errs map<string,double>")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        d, D = int(row["d"]), int(row["sd"])
        n = float(row["n"]) if row["n"] == row["n"] else 0.0
        G = _G(row, len(names) + 1) if n > 0 else None
        out = []
        for p in ORDER_VALUES:
            for q in ORDER_VALUES:
                for P in ORDER_VALUES:
                    for Q in ORDER_VALUES:
                        pos = (p * 4 + d * 2 + q) * 8 + (P * 4 + D * 2 + Q)
                        ar = (["u1"] if p else []) + ([f"u{s}"] if P else []) + ([f"u{s + 1}"] if p and P else [])
                        ma = (["e1"] if q else []) + ([f"e{s}"] if Q else []) + ([f"e{s + 1}"] if q and Q else [])
                        cols = ar + ma
                        rec = {**{k: row[k] for k in keys}, "grid_pos": pos, "p": p, "d": d, "q": q, "sp": P,
                               "sd": D, "sq": Q, "s": s, "aic": None, "sigma2": None, "n_eff": int(n),
                               "stationary": None, "invertible": None, "error": None, "coefs": None,
                               "std_errs": None}
                        k = len(cols) + kx + 1
                        idx = [names.index(c) for c in cols]
                        tgt = len(names)
                        if n <= k:
                            rec["error"] = f"insufficient rows: {int(n)} for {k} unknowns"
                        elif idx and np.linalg.matrix_rank(G[np.ix_(idx, idx)]) < len(idx):
                            rec["error"] = "singular Gram matrix"
                        if rec["error"]:
                            out.append(rec)
                            continue
                        if idx:
                            b, ssr, inv = _ols(G, idx, tgt)
                        else:
                            b, ssr, inv = np.zeros(0), float(G[tgt, tgt]), np.zeros((0, 0))
                        s2 = ssr / n
                        if s2 <= 0:
                            rec["error"] = "no residual variance"
                            out.append(rec)
                            continue
                        coefs = {c: float(v) for c, v in zip(cols, b)}
                        dof = max(n - len(cols), 1.0)
                        ses = {c: float(math.sqrt(max(ssr / dof * inv[i, i], 0.0))) for i, c in enumerate(cols)}
                        rec.update(aic=float(n * math.log(2 * math.pi * s2) + n + 2 * k), sigma2=float(s2),
                                   stationary=_roots_ok({c: coefs[c] for c in ar}, lag_of, -1.0),
                                   invertible=_roots_ok({c: coefs[c] for c in ma}, lag_of, 1.0),
                                   coefs=coefs, std_errs=ses)
                        out.append(rec)
        return pd.DataFrame(out)

    grid = g2.groupBy(*grp).applyInPandas(solve, schema)
    bcols = [f"b_{c}" for c in xcols]
    return grid.join(beta.select(*grp, *bcols, *[f"se_{c}" for c in bcols],
                                 F.col("sigma2").alias("sigma2_reg")), grp, "left")


def best_model(grid: DataFrame, keys: Sequence[str] = (), require_roots: bool = True,
               within_differencing: bool = False) -> DataFrame:
    """Minimum-AIC candidate per series (first in grid order on ties).

    All candidates of a series are fitted on the same weeks. ``within_differencing``
    picks one winner per ``(series, d, D)`` instead. A series without an
    eligible candidate keeps its row, with a NULL model and the reason in ``error``.
    """
    ok = F.col("aic").isNotNull()
    if require_roots:
        ok = ok & F.col("stationary") & F.col("invertible")
    group = [*keys, "d", "sd"] if within_differencing else list(keys)
    cols = [c for c in grid.columns if c not in group]
    reason = F.coalesce(F.min("error"), F.lit("no candidate with roots outside the unit circle"))
    best = ((grid.groupBy(*group) if group else grid.groupBy())
            .agg(F.min_by(F.struct(*cols), F.when(ok, F.struct("aic", "grid_pos"))).alias("_b"), reason.alias("_why")))
    best = best.select(*group, "_b.*", F.col("_b").isNull().alias("_none"), "_why")
    return best.withColumn("error", F.when(F.col("_none"), F.col("_why")).otherwise(F.col("error"))).select(*grid.columns)


def coef_table(best: DataFrame, xcols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(term, coef, std_err, z, p_value, ci_lo, ci_hi)`` for the chosen model."""
    reg = F.map_from_arrays(F.array(*[F.lit(c) for c in xcols]), F.array(*[F.col(f"b_{c}") for c in xcols]))
    reg_se = F.map_from_arrays(F.array(*[F.lit(c) for c in xcols]), F.array(*[F.col(f"se_b_{c}") for c in xcols]))
    allc = F.map_concat(reg, F.coalesce(F.col("coefs"), F.create_map().cast("map<string,double>")))
    alls = F.map_concat(reg_se, F.coalesce(F.col("std_errs"), F.create_map().cast("map<string,double>")))
    x = best.select(*keys, F.explode(allc).alias("term", "coef"), alls.alias("_se"))
    x = x.select(*keys, "term", "coef", F.col("_se")[F.col("term")].alias("std_err"))
    z = F.try_divide(F.col("coef"), F.col("std_err"))
    return x.select(*keys, "term", "coef", "std_err", z.alias("z"),
                    (2 * (1 - _phi_col(F.abs(z)))).alias("p_value"),
                    (F.col("coef") - CONFIDENCE_Z * F.col("std_err")).alias("ci_lo"),
                    (F.col("coef") + CONFIDENCE_Z * F.col("std_err")).alias("ci_hi"))


def _phi_col(z):
    """Standard normal CDF as a column expression (Abramowitz-Stegun 7.1.26 erf)."""
    x = z / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1.0 - poly * F.exp(-x * x)
    return 0.5 * (1.0 + erf)


def _product(poly: dict[int, Column], lag: int, on: Column) -> dict[int, Column]:
    """A lag polynomial (coefficient by lag) times ``1 - on B^lag``."""
    out = dict(poly)
    for k, c in poly.items():
        out[k + lag] = out.get(k + lag, F.lit(0.0)) - on * c
    return out


def psi_variance(poly: dict[int, Column], theta: dict[int, Column], steps: Column) -> Column:
    """Running sums of the squared psi weights, one for each step ahead.

    psi weights are the coefficients of theta / poly: a fold in which each reads the ones before it.
    """
    def one(state: Column, h: Column) -> Column:
        psi = F.lit(0.0)
        for k, c in theta.items():
            psi = psi + F.when(h == k, c).otherwise(0.0)
        for k, c in poly.items():
            if k:
                psi = psi - c * F.when(h >= k, F.get(state["psi"], h - k)).otherwise(0.0)
        return F.struct(F.array_append(state["psi"], psi).alias("psi"))

    none = F.array().cast("array<double>")
    psi = F.aggregate(F.sequence(F.lit(0), steps - 1), F.struct(none.alias("psi")), one, lambda x: x["psi"])
    add = lambda sums, v: F.array_append(sums, v * v + F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0.0)))
    return F.when(steps > 0, F.aggregate(psi, none, add)).otherwise(none)


def forecast(frame: DataFrame, best: DataFrame, y: str, xcols: Sequence[str], keys: Sequence[str] = (),
             split_col: str = "split", s: int = SEASON, z: float = CONFIDENCE_Z) -> DataFrame:
    """Multi-step forecast of the test span from the end of train, with a 95 % interval.

    A series' weekly rows (bounded by the calendar) are one ordered array, and the error recursion is a fold over
    it: over train, then forward with future innovations zero. The interval uses psi-weights of the full
    (differenced) ARMA polynomial. All of it are column expressions. A series without a model keeps its weeks,
    without a forecast; NaN counts as missing.
    """
    keys, xcols = list(keys), list(xcols)
    number = lambda c: F.when(~F.isnan(c), F.col(c).cast("double"))
    row = F.struct(F.col(T).alias("t"), "week_start", number(y).alias("_y"),
                   *[number(c).alias(f"_x{i}") for i, c in enumerate(xcols)], (F.col(split_col) == "train").alias("_train"))
    series = frame.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    names = {"u": [(f"u{k}", k) for k in (1, s, s + 1)], "e": [(f"e{k}", k) for k in (1, s, s + 1)]}
    coef = {n: F.coalesce(F.col("coefs")[n], F.lit(0.0)).alias(f"_{n}") for part in names.values() for n, _ in part}
    params = best.select(*keys, F.col("d").alias("_d"), F.col("sd").alias("_sd"), F.col("sigma2").alias("_s2"),
                         *coef.values(), *[F.col(f"b_{c}").alias(f"_b{i}") for i, c in enumerate(xcols)])
    j = attach(series, params, keys, "inner")
    r, d, sd = F.col("_rows"), F.col("_d"), F.col("_sd")
    back = ((1, d, 1), (s, sd, 1), (s + 1, d * sd, -1))

    def differenced(name: str, i: Column) -> Column:
        out = F.get(r, i)[name]
        for lag, on, sign in back:
            out = out - sign * F.when(on == 1, F.get(r, i - lag)[name]).otherwise(0.0)
        return out

    def prepared(x: Column, i: Column) -> Column:
        drift = F.lit(0.0)
        for k in range(len(xcols)):
            drift = drift + differenced(f"_x{k}", i) * F.col(f"_b{k}")
        return F.struct(i.alias("i"), x["t"].alias("t"), x["week_start"].alias("week_start"), x["_train"].alias("train"),
                        x["_y"].alias("y"), drift.alias("drift"), F.when(x["_train"], differenced("_y", i)).alias("w"))

    def step(state: Column, x: Column) -> Column:
        def part(kind: str, of: str) -> Column:
            total = F.lit(0.0)
            for name, lag in names[kind]:
                total = total + F.col(f"_{name}") * F.when(x["i"] >= lag, F.get(state[of], x["i"] - lag)).otherwise(0.0)
            return total

        expected, u = part("u", "u") + part("e", "e"), x["w"] - x["drift"]
        shown = F.when(x["train"], F.coalesce(u, F.lit(0.0))).otherwise(expected)
        error = F.when(x["train"] & u.isNotNull(), u - expected).otherwise(0.0)
        level = x["drift"] + expected
        for lag, on, sign in back:  # from differences back to levels
            level = level + sign * F.when((on == 1) & (x["i"] >= lag), F.get(state["y"], x["i"] - lag)).otherwise(0.0)
        return F.struct(F.array_append(state["u"], shown).alias("u"), F.array_append(state["e"], error).alias("e"),
                        F.array_append(state["y"], F.when(x["train"], x["y"]).otherwise(level)).alias("y"))

    none = F.array().cast("array<double>")
    poly = {0: F.lit(1.0), **{k: -F.col(f"_{n}") for n, k in names["u"]}}
    poly = _product(_product(poly, 1, d), s, sd)
    theta = {0: F.lit(1.0), **{k: F.col(f"_{n}") for n, k in names["e"]}}
    x = j.withColumn("_steps", F.transform(r, prepared))
    ahead = F.filter(F.col("_steps"), lambda v: ~v["train"])
    # the levels of the fold that ``step`` makes, beside the weeks they are for
    x = x.select(*keys, "_d", "_s2", ahead.alias("_ahead"), F.aggregate(
        "_steps", F.struct(none.alias("u"), none.alias("e"), none.alias("y")), step, lambda v: v["y"]).alias("_level"),
        psi_variance(poly, theta, F.size(ahead)).alias("_var"))
    x = x.select(*keys, "_d", "_s2", "_level", "_var", F.posexplode("_ahead").alias("_h", "_week"))
    finite = lambda c: F.when(F.abs(c) < float("inf"), c)  # noqa: E731  NULL, never NaN or infinity, in the output
    x = x.withColumn("_point", F.when(F.col("_d").isNotNull(), F.get("_level", F.col("_week.i")))) \
         .withColumn("_half", z * F.sqrt(F.col("_s2") * F.get("_var", F.col("_h"))))
    return x.select(*keys, F.col("_week.week_start").alias("week_start"), F.col("_week.t").cast("int").alias("t_idx"),
                    finite(F.col("_point")).alias("predicted"), finite(F.col("_point") - F.col("_half")).alias("ci_lo"),
                    finite(F.col("_point") + F.col("_half")).alias("ci_hi"))


def forecast_vs_observed(fc: DataFrame, frame: DataFrame, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Observed vs predicted per test week, with the series' RMSE and MAPE."""
    keys = list(keys)
    j = fc.join(frame.select(*keys, "week_start", F.col(y).alias("observed")), [*keys, "week_start"], "left")
    wp = Window.partitionBy(*keys)
    err = F.col("observed") - F.col("predicted")
    return j.select("*", F.sqrt(F.avg(err * err).over(wp)).alias("rmse"),
                    F.avg(F.when(F.col("observed") != 0, F.abs(err / F.col("observed")))).over(wp).alias("mape"))


def run_log(best: DataFrame, run_id: str, run_ts: str, keys: Sequence[str] = (),
            metrics: DataFrame | None = None) -> DataFrame:
    """One row per series: the selected model's orders and AIC (the winner, not the last fit)."""
    keys = list(keys)
    order = F.format_string("(%d, %d, %d)", "p", "d", "q")
    sorder = F.format_string("(%d, %d, %d, %d)", "sp", "sd", "sq", "s")
    out = best.select(*keys, F.lit(run_id).alias("run_id"), F.lit(run_ts).cast("timestamp_ntz").alias("run_ts"),
                      F.when(F.col("p").isNull(), F.create_map(F.lit("error"), F.col("error")))
                      .otherwise(F.create_map(F.lit("order"), order, F.lit("seasonal_order"), sorder)).alias("params"),
                      F.create_map(F.lit("AIC"), F.col("aic")).alias("metrics"))
    if metrics is not None:
        m = metrics.groupBy(*keys).agg(F.first("rmse").alias("rmse"), F.first("mape").alias("mape"))
        out = (attach(out, m, keys, "left")
               .withColumn("metrics", F.map_concat("metrics", F.create_map(F.lit("rmse"), F.col("rmse"),
                                                                           F.lit("mape"), F.col("mape"))))
               .drop("rmse", "mape"))
    return out

