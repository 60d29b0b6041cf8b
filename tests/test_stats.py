import datetime as dt

import numpy as np

from panelkit.operators import multivar as M
from panelkit.operators import seasonal as SE
from panelkit.operators import tsstats as TS

d = dt.date


def series_df(spark, cols: dict, key="k"):
    n = len(next(iter(cols.values())))
    names = list(cols)
    rows = [(key, d(2000, 1, 2) + dt.timedelta(weeks=i), i, *[float(cols[c][i]) for c in names]) for i in range(n)]
    schema = "k string, week_start date, t_idx int, " + ", ".join(f"{c} double" for c in names)
    return spark.createDataFrame(rows, schema)


def test_standardize_population_sigma(spark):
    df = series_df(spark, {"a": [1, 2, 3, 4], "c": [5, 5, 5, 5]})
    out = M.standardize(df, ["a", "c"], ["k"]).orderBy("t_idx").toPandas()
    a = np.array([1, 2, 3, 4.0])
    assert np.allclose(out["a"], (a - a.mean()) / a.std(ddof=0))
    assert (out["c"] == 0).all()


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5))
    df = series_df(spark, {f"f{i}": X[:, i] for i in range(5)})
    cols = [f"f{i}" for i in range(5)]
    model = M.pca_model(df, cols, ["k"]).toPandas()
    vals, vecs = np.linalg.eigh(np.cov(X, rowvar=False))
    vals = vals[::-1]
    ev = model.drop_duplicates("component").sort_values("component")["eigenvalue"].to_numpy()
    assert np.allclose(ev, vals)
    sc = M.pca_scores(df, M.pca_model(df, cols, ["k"]), cols, 2, ["k"]).orderBy("t_idx").toPandas()
    assert np.allclose(sc["PC1"].var(ddof=1), vals[0]) and np.allclose(sc["PC2"].var(ddof=1), vals[1])
    load = model.pivot(index="feature", columns="component", values="loading").to_numpy()
    assert np.allclose(load.T @ load, np.eye(5), atol=1e-8)


def test_acf_pacf_match_numpy(spark):
    rng = np.random.default_rng(2)
    e = rng.normal(size=300)
    x = np.zeros(300)
    for t in range(1, 300):
        x[t] = 0.6 * x[t - 1] + e[t]
    df = series_df(spark, {"x": x})
    a = TS.acf(df, "x", 5, ["k"]).orderBy("lag").toPandas()
    c = x - x.mean()
    ref = np.array([np.sum(c[k:] * c[:-k]) / np.sum(c * c) for k in range(1, 6)])
    assert np.allclose(a["acf"], ref)
    p = TS.pacf(TS.acf(df, "x", 5, ["k"]), ["k"]).orderBy("lag").toPandas()
    r = np.r_[1, ref]
    for k in range(1, 6):  # Yule-Walker solve: last coefficient of order-k fit
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(R, r[1:k + 1])
        assert np.isclose(p["pacf"].iloc[k - 1], phi[-1])


def test_adf_statistic_matches_numpy_ols(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=150).cumsum() * 0.1 + rng.normal(size=150)
    df = series_df(spark, {"x": x})
    r = TS.adf(df, "x", ["k"]).first()
    L, n = r.used_lag, len(x)
    dx = np.diff(x)
    rows = range(L, n - 1)
    Z = np.array([[1.0, x[j]] + [dx[j - i] for i in range(1, L + 1)] for j in rows])
    yv = np.array([dx[j] for j in rows])
    b, *_ = np.linalg.lstsq(Z, yv, rcond=None)
    res = yv - Z @ b
    s2 = res @ res / (len(yv) - Z.shape[1])
    se = np.sqrt(s2 * np.linalg.inv(Z.T @ Z)[1, 1])
    assert np.isclose(r.adf_stat, b[1] / se) and r.nobs == len(yv)
    assert abs(TS.mackinnon_p(-2.86) - 0.05) < 0.003


def test_grid_recovers_seasonal_ar(spark):
    rng = np.random.default_rng(4)
    n = 700
    u = np.zeros(n)
    e = rng.normal(size=n)
    for t in range(53, n):
        u[t] = 0.6 * u[t - 1] + e[t]
    pc = rng.normal(size=n)
    y = 2.0 * pc + u
    df = series_df(spark, {"y": y, "PC1": pc})
    grid = SE.seasonal_arx_grid(df, "y", ["PC1"], ["k"])
    assert grid.count() == 64
    best = SE.best_model(grid, ["k"]).first()
    assert best.p == 1 and best.d == 0
    assert abs(best.coefs["u1"] - 0.6) < 0.1 and abs(best.b_PC1 - 2.0) < 0.1
    assert SE.candidate_grid(spark).count() == 64
