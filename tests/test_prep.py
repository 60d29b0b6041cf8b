import datetime as dt

import numpy as np
import pytest

from panelkit.operators import prep as R

d = dt.date


def frame(spark, ys, extra=None, key="k"):
    rows = []
    for i, y in enumerate(ys):
        rows.append((key, d(2020, 1, 5) + dt.timedelta(weeks=i), i, None if y is None else float(y),
                     None if extra is None or extra[i] is None else float(extra[i])))
    return spark.createDataFrame(rows, "k string, week_start date, t_idx int, y double, x double")


def test_decompose_identity_and_numpy_trend(spark):
    rng = np.random.default_rng(0)
    n = 160
    ys = 10 + np.sin(np.arange(n) * 2 * np.pi / 52) * 3 + rng.normal(size=n)
    out = R.decompose(frame(spark, ys), "y", ["k"], 52).orderBy("t_idx").toPandas()
    filt = np.r_[0.5, np.ones(51), 0.5] / 52
    trend = np.convolve(ys, filt, mode="valid")
    got = out["trend"].to_numpy()[26:n - 26]
    assert np.allclose(got, trend)
    assert out["trend"].iloc[:26].isna().all() and out["trend"].iloc[-26:].isna().all()
    ok = out.dropna()
    assert np.allclose(ok["trend"] + ok["seasonal"] + ok["resid"], ok["y"])


def test_outlier_row_blanked(spark):
    ys = [0] * 20 + [100]
    xs = list(range(21))
    out = R.outlier_blank(frame(spark, ys, xs), "y", ["x", "y"], ["k"]).orderBy("t_idx").collect()
    last = out[-1]
    assert last.is_outlier and last.y == 0.0 and last.x is None
    assert not any(r.is_outlier for r in out[:-1])


def test_interpolation_exact_for_cubic_and_keeps_known(spark):
    t = np.arange(30, dtype=float)
    truth = 0.5 * t ** 3 - 2 * t ** 2 + t - 4
    xs = [None if i in (0, 12, 13, 14, 29) else v for i, v in enumerate(truth)]
    df = frame(spark, [0] * 30, xs)
    out = R.interpolate_cubic(df, ["x"], ["k"]).orderBy("t_idx").toPandas()
    assert np.isnan(out["x"].iloc[0])                     # leading stays NULL
    assert np.allclose(out["x"].iloc[12:15], truth[12:15])  # cubic exact inside
    known = [i for i in range(1, 29) if i not in (12, 13, 14)]
    assert np.allclose(out["x"].iloc[known], truth[known])
    assert not np.isnan(out["x"].iloc[29])                # trailing extrapolated
    held = R.interpolate_cubic(df, ["x"], ["k"], leading="hold").orderBy("t_idx").toPandas()
    assert held["x"].iloc[0] == truth[1]


@pytest.mark.parametrize("n,train", [(344, 275), (13, 10)])
def test_chrono_split(spark, n, train):
    out = R.chrono_split(frame(spark, range(n)), ["k"]).where("split = 'train'").count()
    assert out == train


def test_difference(spark):
    out = R.difference(frame(spark, [1, 4, 9, 16]), "y", ["k"]).orderBy("t_idx").collect()
    assert [r.y_diff for r in out] == [None, 3.0, 5.0, 7.0]


def test_natural_spline_reproduces_lines_and_keeps_known(spark):
    t = np.arange(25, dtype=float)
    truth = 3 * t - 7
    xs = [None if i in (0, 5, 6, 15, 24) else v for i, v in enumerate(truth)]
    out = R.interpolate_spline(frame(spark, [0] * 25, xs), ["x"], ["k"]).orderBy("t_idx").toPandas()
    assert np.isnan(out["x"].iloc[0])
    assert np.allclose(out["x"].iloc[1:], truth[1:])


def test_natural_spline_matches_dense_solve():
    rng = np.random.default_rng(5)
    x = np.arange(12, dtype=float)
    y = rng.normal(size=12)
    y_nan = y.copy()
    y_nan[[4, 7]] = np.nan
    got = R._natural_spline_fill(x, y_nan)
    xs, ys = np.delete(x, [4, 7]), np.delete(y, [4, 7])
    m = len(xs)
    h = np.diff(xs)
    A = np.zeros((m, m))
    r = np.zeros(m)
    A[0, 0] = A[-1, -1] = 1
    for i in range(1, m - 1):
        A[i, i - 1], A[i, i], A[i, i + 1] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        r[i] = 6 * ((ys[i + 1] - ys[i]) / h[i] - (ys[i] - ys[i - 1]) / h[i - 1])
    M = np.linalg.solve(A, r)
    for t in (4, 7):
        i = np.searchsorted(xs, x[t]) - 1
        a, b = (xs[i + 1] - x[t]) / h[i], (x[t] - xs[i]) / h[i]
        exp = a * ys[i] + b * ys[i + 1] + ((a ** 3 - a) * M[i] + (b ** 3 - b) * M[i + 1]) * h[i] ** 2 / 6
        assert np.isclose(got[t], exp)
