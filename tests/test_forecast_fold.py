"""The forecast's folds against plain recursions on the undifferenced lag polynomial."""

import datetime as dt

import numpy as np
import pytest

from panelkit.operators import seasonal as SE

S = 4  # a short season keeps the polynomials readable


def brute(y, x, n_train, d, sd, c, beta, sigma2, z):
    """Innovations of the ARMA equation of the differenced regression errors, then future values by the same equation."""
    one = lambda lag, on: np.array([1.0] + [0.0] * (lag - 1) + [-float(on)])
    diff = np.convolve(one(1, d), one(S, sd))
    def lagged(names):
        out = np.zeros(S + 2)
        out[[1, S, S + 1]] = [c.get(n, 0.0) for n in names]
        return out
    ar, ma = lagged(["u1", f"u{S}", f"u{S + 1}"]), lagged(["e1", f"e{S}", f"e{S + 1}"])
    deg = max(lag for lag, v in enumerate(diff) if v or lag == 0)
    w = lambda v, t: sum(diff[k] * v[t - k] for k in range(deg + 1)) if t >= deg else None
    u, e, out = np.zeros(len(y)), np.zeros(len(y)), y.astype(float).copy()
    for t in range(len(y)):
        expected = sum(ar[k] * u[t - k] + ma[k] * e[t - k] for k in range(1, S + 2) if t >= k)
        if t < n_train:
            if w(y, t) is not None:
                u[t] = w(y, t) - w(x, t) * beta
                e[t] = u[t] - expected
        else:
            u[t] = expected
            out[t] = w(x, t) * beta + expected - sum(diff[k] * out[t - k] for k in range(1, deg + 1))
    poly = np.convolve(np.concatenate([[1.0], -ar[1:]]), diff)
    psi = []
    for h in range(len(y) - n_train):
        v = (1.0 if h == 0 else ma[h] if h < len(ma) else 0.0)
        psi.append(v - sum(poly[k] * psi[h - k] for k in range(1, min(h, len(poly) - 1) + 1)))
    half = z * np.sqrt(sigma2 * np.cumsum(np.square(psi)))
    return out[n_train:], half


@pytest.mark.parametrize("d,sd", [(0, 0), (1, 0), (0, 1), (1, 1)])
def test_forecast(spark, d, sd):
    rng = np.random.default_rng(3)
    n, n_train = 40, 30
    y, x = rng.normal(50, 5, n).round(2), rng.normal(0, 1, n).round(3)
    c = {"u1": 0.4, f"u{S}": -0.3, f"u{S + 1}": 0.12, "e1": 0.25, f"e{S + 1}": -0.2}
    frame = spark.createDataFrame([("k", t, dt.date(2025, 1, 5) + dt.timedelta(weeks=t), float(y[t]), float(x[t]),
                                    "train" if t < n_train else "test") for t in range(n)],
                                  "key string, t_idx int, week_start date, y double, x double, split string")
    model = "key string, d int, sd int, coefs map<string,double>, sigma2 double, b_x double"
    best = spark.createDataFrame([("k", d, sd, c, 2.5, 1.7)], model)
    got = sorted(SE.forecast(frame, best, "y", ["x"], ["key"], s=S, z=2.0).collect(), key=lambda r: r.t_idx)
    point, half = brute(y, x, n_train, d, sd, c, 1.7, 2.5, 2.0)
    assert [r.t_idx for r in got] == list(range(n_train, n)) and got[0].week_start == dt.date(2025, 1, 5) + dt.timedelta(weeks=30)
    assert np.allclose([r.predicted for r in got], point, rtol=0, atol=1e-9)
    assert np.allclose([r.ci_hi - r.predicted for r in got], half, rtol=0, atol=1e-9)
    none = spark.createDataFrame([("k", None, None, None, None, None)], model)
    kept = SE.forecast(frame, none, "y", ["x"], ["key"], s=S).collect()
    assert len(kept) == n - n_train and all(r.predicted is None and r.ci_lo is None for r in kept)
    single = SE.forecast(frame.drop("key"), best.drop("key"), "y", ["x"], s=S, z=2.0).orderBy("t_idx").collect()
    assert [r.predicted for r in single] == [r.predicted for r in got]
    plan = SE.forecast(frame, best, "y", ["x"], ["key"], s=S)._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan
