"""Per-series time-series preparation with window functions.

Every window is ``partitionBy(series keys).orderBy(t_idx)``. The panel has one
row per (series, week), so a window partition holds at most the number of
weeks of one series (a few hundred to a few thousand rows) however skewed the
raw events were; that bound is what makes per-series windows safe at scale.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.constants import OUTLIER_K, SEASON, TRAIN_SHARE

T = "t_idx"


def _w(keys, order=T):
    return Window.partitionBy(*keys).orderBy(order)


def model_frame(panel: DataFrame, exog: Sequence[str], outcome: str, keys: Sequence[str] = (),
                week_col: str = "week_start") -> DataFrame:
    """Sorted modelling frame: ``t_idx`` (0-based position), exogenous as doubles."""
    return panel.select(*keys, week_col,
                        (F.row_number().over(_w(keys, week_col)) - 1).alias(T),
                        *[F.col(c).try_cast("double").alias(c) for c in exog],
                        F.col(outcome).cast("double").alias(outcome))


def difference(df: DataFrame, col: str, keys: Sequence[str] = (), lag: int = 1,
               out: str | None = None, dropna: bool = False) -> DataFrame:
    """``x - x.shift(lag)`` per series (positional lag)."""
    out = out or f"{col}_diff"
    r = df.withColumn(out, F.col(col) - F.lag(col, lag).over(_w(keys)))
    return r.where(F.col(out).isNotNull()) if dropna else r


def decompose(df: DataFrame, col: str, keys: Sequence[str] = (), period: int = SEASON) -> DataFrame:
    """Additive decomposition: centred moving-average trend, phase-mean seasonal, residual.

    Even period: 2 x period MA (half weights at both ends), NULL where the
    window is incomplete. Seasonal: mean detrended value per phase
    ``t_idx % period``, minus the mean of the phase means.
    """
    h = period // 2
    w = _w(keys)
    frame = w.rowsBetween(-h, h)
    x = F.col(col)
    if period % 2 == 0:
        trend = (F.sum(x).over(frame) - 0.5 * F.lag(x, h).over(w) - 0.5 * F.lead(x, h).over(w)) / period
    else:
        trend = F.avg(x).over(frame)
    full = F.count(x).over(frame) == (2 * h + 1)
    d = df.withColumn("trend", F.when(full, trend)).withColumn("_phase", F.col(T) % period)
    phase = (d.groupBy(*keys, "_phase").agg(F.avg(F.col(col) - F.col("trend")).alias("_pm")))
    phase = phase.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(Window.partitionBy(*keys)))
    return (d.join(phase.drop("_pm"), [*keys, "_phase"], "left").drop("_phase")
            .withColumn("resid", F.col(col) - F.col("trend") - F.col("seasonal")))


def outlier_blank(df: DataFrame, outcome: str, value_cols: Sequence[str], keys: Sequence[str] = (),
                  k: float = OUTLIER_K) -> DataFrame:
    """Rows with ``|y - median| > k * std`` lose every value; y is then filled with the median.

    Median and sample std come from the data before blanking; the whole row
    (outcome and exogenous values) is blanked, as in the studied job.
    """
    if keys:  # one pass: per-series statistics as whole-partition windows
        w = Window.partitionBy(*keys)
        j = df.select("*", F.median(outcome).over(w).alias("_med"), F.stddev_samp(outcome).over(w).alias("_sd"))
    else:  # one series: two scalar subqueries
        j = df.select("*", df.select(F.median(outcome)).scalar().alias("_med"),
                      df.select(F.stddev_samp(outcome)).scalar().alias("_sd"))
    mask = F.coalesce(F.abs(F.col(outcome) - F.col("_med")) > k * F.col("_sd"), F.lit(False))
    vals = [c for c in value_cols if c != outcome]
    return j.select(*[c for c in df.columns if c not in vals and c != outcome],
                    *[F.when(mask, F.lit(None).cast("double")).otherwise(F.col(c)).alias(c) for c in vals],
                    F.coalesce(F.when(mask, F.lit(None).cast("double")).otherwise(F.col(outcome)),
                               F.col("_med")).alias(outcome),
                    mask.alias("is_outlier"))


def _epoch_weeks(c) -> Column:
    return F.datediff(c, F.lit(_dt.date(1970, 1, 4))) / 7.0


def interpolate_cubic(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
                      x_col: str = "week_start", trailing: str = "extrapolate",
                      leading: str = "null") -> DataFrame:
    """Fill NULL cells with a local cubic through the two known points before and
    the two after (Lagrange form); linear with fewer knots; leading NULLs stay.

    ``x`` is time in weeks (calendar, not position). Trailing NULLs:
    ``extrapolate`` (linear from the last two knots), ``hold`` or ``null``;
    leading NULLs: ``null`` (kept, as the studied job does) or ``hold``
    (first known value, needed before PCA which admits no NULL).

    Known cells are never changed. The frame is unpivoted to
    ``(keys, variable, x, value)`` so one small set of window expressions,
    partitioned by ``(keys, variable)``, serves every column (parallel over
    series x variables), then pivoted back with one aggregate. ``(keys,
    x_col)`` must identify a row.
    """
    if trailing not in ("extrapolate", "hold", "null"):
        raise ValueError(trailing)
    cols = list(cols)
    keys = list(keys)
    other = [c for c in df.columns if c not in cols and c not in keys and c != x_col]
    stack = "stack({}, {}) as (_var, _val)".format(
        len(cols), ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols))
    long = df.select(*keys, x_col, *other, F.expr(stack))
    w = Window.partitionBy(*keys, "_var").orderBy(x_col)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(1, Window.unboundedFollowing)
    v = F.col("_val")
    known = F.when(v.isNotNull(), F.struct(_epoch_weeks(F.col(x_col)).alias("x"), v.alias("y")))
    d = long.select("*", F.last(known, ignorenulls=True).over(before).alias("_p"),
                    F.first(known, ignorenulls=True).over(after).alias("_n"))
    d = d.select("*", F.last(F.when(v.isNotNull(), F.col("_p")), ignorenulls=True).over(before).alias("_pp"),
                 F.first(F.when(v.isNotNull(), F.col("_n")), ignorenulls=True).over(after).alias("_nn"))
    t = _epoch_weeks(F.col(x_col))
    p, n, pp, nn = F.col("_p"), F.col("_n"), F.col("_pp"), F.col("_nn")
    cubic = _lagrange4(t, pp, p, n, nn)
    linear = p["y"] + (n["y"] - p["y"]) * (t - p["x"]) / (n["x"] - p["x"])
    inside = F.when(pp.isNotNull() & nn.isNotNull(), cubic).otherwise(linear)
    if trailing == "extrapolate":
        tail = F.when(pp.isNotNull(), p["y"] + (p["y"] - pp["y"]) * (t - p["x"]) / (p["x"] - pp["x"])
                      ).otherwise(p["y"])
    elif trailing == "hold":
        tail = p["y"]
    else:
        tail = F.lit(None).cast("double")
    filled = (F.when(v.isNotNull(), v)
              .when(p.isNotNull() & n.isNotNull(), inside)
              .when(p.isNotNull(), tail))
    if leading == "hold":
        filled = F.coalesce(filled, n["y"])
    wide = (d.select(*keys, x_col, *other, "_var", filled.alias("_f"))
            .groupBy(*keys, x_col)
            .agg(*[F.first(c).alias(c) for c in other],
                 F.map_from_entries(F.collect_list(F.struct("_var", "_f"))).alias("_m")))
    return wide.select(*[F.col("_m")[c].alias(c) if c in cols else F.col(c) for c in df.columns])


def _lagrange4(t, a, b, c, d) -> Column:
    pts = [a, b, c, d]
    total = None
    for i, pi in enumerate(pts):
        term = pi["y"]
        for j, pj in enumerate(pts):
            if i != j:
                term = term * (t - pj["x"]) / (pi["x"] - pj["x"])
        total = term if total is None else total + term
    return total


def chrono_split(df: DataFrame, keys: Sequence[str] = (), share: float = TRAIN_SHARE) -> DataFrame:
    """First ``round_half_even(share * n)`` positions of each series are train."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    cut = F.bround(F.lit(share) * n, 0)
    return (df.withColumn("n_train", cut.cast("int"))
            .withColumn("split", F.when(F.col(T) < F.col("n_train"), F.lit("train")).otherwise(F.lit("test"))))


def _natural_spline_fill(x: "np.ndarray", y: "np.ndarray") -> "np.ndarray":
    """Fill NaN in ``y`` from the natural cubic spline through the known points.

    Leading NaN stay NaN; trailing ones follow the spline's linear end
    extension (a natural spline has zero curvature at its ends).
    """
    import numpy as np
    out = y.copy()
    known = ~np.isnan(y)
    xs, ys = x[known], y[known]
    m = len(xs)
    if m == 0:
        return out
    if m == 1:
        out[~known & (x > xs[0])] = ys[0]
        return out
    h = np.diff(xs)
    M = np.zeros(m)
    if m > 2:  # Thomas algorithm for the interior second derivatives
        a = h[:-1].copy()
        b = 2 * (h[:-1] + h[1:])
        c = h[1:].copy()
        r = 6 * ((ys[2:] - ys[1:-1]) / h[1:] - (ys[1:-1] - ys[:-2]) / h[:-1])
        n = m - 2
        for i in range(1, n):
            w = a[i] / b[i - 1]
            b[i] -= w * c[i - 1]
            r[i] -= w * r[i - 1]
        sol = np.zeros(n)
        sol[-1] = r[-1] / b[-1]
        for i in range(n - 2, -1, -1):
            sol[i] = (r[i] - c[i] * sol[i + 1]) / b[i]
        M[1:-1] = sol
    todo = np.where(~known & (x > xs[0]))[0]
    for t in todo:
        xv = x[t]
        if xv >= xs[-1]:
            slope = (ys[-1] - ys[-2]) / h[-1] + h[-1] * (2 * M[-1] + M[-2]) / 6
            out[t] = ys[-1] + slope * (xv - xs[-1])
            continue
        i = int(np.searchsorted(xs, xv) - 1)
        hi = h[i]
        A = (xs[i + 1] - xv) / hi
        B = (xv - xs[i]) / hi
        out[t] = (A * ys[i] + B * ys[i + 1]
                  + ((A ** 3 - A) * M[i] + (B ** 3 - B) * M[i + 1]) * hi * hi / 6)
    return out


def interpolate_spline(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
                       x_col: str = "week_start") -> DataFrame:
    """Natural cubic spline interpolation per ``(series, variable)``.

    The frame is unpivoted to ``(keys, variable, x, value)``; each
    ``(series, variable)`` group (one value per week, bounded by the
    calendar) solves its tridiagonal system in a grouped-map function; the
    result is pivoted back with one aggregate. Known cells are unchanged,
    leading NULLs stay. Closer in spirit to a library spline than
    ``interpolate_cubic`` but still not a smoothing spline.
    """
    import numpy as np
    import pandas as pd
    cols, keys = list(cols), list(keys)
    other = [c for c in df.columns if c not in cols and c not in keys and c != x_col]
    stack = "stack({}, {}) as (_var, _val)".format(
        len(cols), ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols))
    long = df.select(*keys, x_col, _epoch_weeks(F.col(x_col)).alias("_x"), F.expr(stack))
    fields = [f for f in long.schema.fields if f.name in keys or f.name == x_col]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", _var string, _f double"

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_x")
        f = _natural_spline_fill(pdf["_x"].to_numpy(dtype=float), pdf["_val"].to_numpy(dtype=float))
        res = pdf[[*keys, x_col, "_var"]].copy()
        res["_f"] = np.where(np.isnan(f), None, f)
        return res[[*keys, x_col, "_var", "_f"]]

    filled = long.groupBy(*keys, "_var").applyInPandas(fill, schema)
    wide = (filled.groupBy(*keys, x_col)
            .agg(F.map_from_entries(F.collect_list(F.struct("_var", "_f"))).alias("_m")))
    base = df.select(*keys, x_col, *other)
    return (base.join(wide, [*keys, x_col], "left")
            .select(*[F.col("_m")[c].alias(c) if c in cols else F.col(c) for c in df.columns]))
