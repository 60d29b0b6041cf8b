"""One series over many blocks against numpy on the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import longseries as L
from panelkit.operators import prep as R


def frame(spark, values, shuffle=True):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    if shuffle:
        np.random.default_rng(1).shuffle(rows)
    return spark.createDataFrame([(int(i), v) for i, v in rows], "t long, v double").repartition(5)


def by_pos(df, col):
    return [r[col] for r in df.orderBy(L.POS).collect()]


def test_positions(spark):
    placed = L.positions(frame(spark, range(1000)), ["t"])
    assert sorted((r.pos, r.t) for r in placed.collect()) == [(i, i) for i in range(1000)]
    assert L.positions(frame(spark, range(3)).limit(0), ["t"]).count() == 0


@pytest.mark.parametrize("size", [60, 500, 5000])
def test_difference_and_decomposition(spark, size):
    v = np.random.default_rng(2).normal(0, 10, 700).round(3)
    s = L.positions(frame(spark, v), ["t"])
    assert by_pos(L.difference(s, "v", 5, size=size), "v_diff") == [None] * 5 + [float(a - b) for a, b in zip(v[5:], v)]
    for period in (12, 7):
        whole = R.decompose(s.withColumn("t_idx", F.col("pos")).withColumn("k", F.lit(1)), "v", ["k"], period)
        exp = whole.orderBy("pos").select("trend", "seasonal", "resid").collect()
        got = L.decompose(s, "v", period, size=size).orderBy("pos").select("trend", "seasonal", "resid").collect()
        for a, b in zip(got, exp):
            assert all((x is None and y is None) or abs(x - y) < 1e-9 for x, y in zip(a, b))
    with pytest.raises(ValueError):
        L.difference(s, "v", size + 1, size=size)


def test_no_window_without_keys(spark):
    s = L.positions(frame(spark, range(100)), ["t"])
    plan = L.decompose(s, "v", 12)._jdf.queryExecution().executedPlan().toString()
    assert "Window [" in plan and "SinglePartition" not in "".join(x for x in plan.splitlines() if "Window" in x)


def test_median(spark, monkeypatch):
    monkeypatch.setattr(L, "FEW", 3)
    rng = np.random.default_rng(3)
    cases = [[5.0], [1, 2], [2, 1, 3], [7] * 50, [0] * 30 + [1] * 30, [0] * 31 + [1] * 30, [1, float("nan"), 3, None],
             list(rng.normal(size=501)), list(rng.integers(0, 5, 400)), [-1e308, 1e308] * 10, list(rng.lognormal(0, 9, 600)),
             list(range(1000))]
    for values in cases:
        whole = [v for v in values if v is not None and v == v]
        got = L.median(frame(spark, values, False), "v")
        assert got == pytest.approx(float(np.median(whole)), rel=1e-12, abs=1e-300), values[:5]
    assert L.median(frame(spark, [None, float("nan")], False), "v") is None


@pytest.mark.parametrize("size", [66, 150, 1024])
def test_spline_in_blocks_equals_the_whole(spark, size):
    rng = np.random.default_rng(4)
    v = rng.normal(0, 5, 600).cumsum()
    gaps = rng.random(600) < 0.5
    gaps[:4] = gaps[-7:] = True
    gaps[200:260] = True
    values = [None if g else float(x) for g, x in zip(gaps, v)]
    s = L.positions(frame(spark, values), ["t"])
    got = by_pos(L.interpolate_spline(s, "v", size), "v")
    exp = R._natural_spline_fill(np.arange(600.0), np.array([np.nan if x is None else x for x in values]))
    assert got[:4] == [None] * 4 and np.abs(np.array(got[4:], float) - exp[4:]).max() < 1e-9
    assert got[10] == values[10] or gaps[10]


@pytest.mark.parametrize("values", [[None, None], [None, 3, None], [1, None, None, 7, None], [1, 2, 3]])
def test_spline_with_few_knots(spark, values):
    s = L.positions(frame(spark, values), ["t"])
    got = by_pos(L.interpolate_spline(s, "v"), "v")
    exp = R._natural_spline_fill(np.arange(float(len(values))), np.array([np.nan if x is None else x for x in values], float))
    assert [None if np.isnan(e) else round(e, 9) for e in exp] == [None if g is None else round(g, 9) for g in got]


def test_outliers(spark):
    v = [float(x) for x in range(50)] + [1e6]
    out = L.outlier_blank(L.positions(frame(spark, v), ["t"]), "v").orderBy("pos").collect()
    assert [r.is_outlier for r in out] == [False] * 50 + [True] and out[-1].v == 25.0
