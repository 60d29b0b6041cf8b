"""Whitening against numpy's eigenvectors, and its edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import whitening
from panelkit.llm.common import table


def brute(vectors, k):
    """Exact deviations, whitened columns (any sign), shares of the variance."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    deviation = ((n * x - s) ** 2).sum(1)
    y = (n * x - s) / n
    e, p = np.linalg.eigh(y.T @ y / n)
    e, p = e[::-1][:k], p[:, ::-1][:, :k]
    return deviation, y @ p / np.sqrt(e), e / np.trace(y.T @ y / n)


def test_query_against_numpy(spark, sf):
    rows = table(spark, sf, "embeddings")
    given = sorted(rows.collect(), key=lambda r: r.vec_id)
    out = whitening.whiten(rows).collect()
    k = min(32, len(given[0].embedding))
    assert len(out) == len(given) * k
    deviation, white, explained = brute([r.embedding for r in given], k)
    place = {r.vec_id: i for i, r in enumerate(given)}
    got = np.zeros((len(given), k))
    for r in out:
        i = place[r.vec_id]
        got[i, r.component - 1] = r.whitened
        assert (r.n, r.deviation) == (len(given), deviation[i])
        assert abs(r.explained - explained[r.component - 1]) < 1e-9 and r.identity_error < 1e-9
    sign = np.sign((got * white).sum(0))
    assert np.abs(got * sign - white).max() < 1e-8


def test_edges(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 1.0, 0.5]), (3, None), (4, [1.0, None, 2.0]), (5, [1.0, float("nan"), 2.0]),
            (6, [1.0, float("inf"), 2.0]), (7, [1e30, 1.0, 1.0]), (8, [0.25, -4.0]), (9, []), (2, [2.0, 1.0, 0.5]),
            (None, [0.0, 0.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("component", F.lit("x"))
    out = whitening.whiten(df).collect()
    stay = [r for r in rows if r[0] not in (3, 4, 5, 6, 7)]
    assert sorted((str(r.vec_id), r.component) for r in out) == sorted((str(i), c) for i, _ in stay for c in (1, 2, 3))
    whole = [list(v) + [0.0] * (3 - len(v)) for _, v in stay]
    deviation, _, explained = brute(whole, 3)
    assert {(r.vec_id, r.deviation) for r in out} == {(i, d) for (i, _), d in zip(stay, deviation.tolist())}
    assert all(abs(r.explained - explained[r.component - 1]) < 1e-9 for r in out)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id in (3, 9)")).count() == 0


def test_no_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    out = whitening.whiten(same).collect()
    assert len(out) == 10 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in out)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<float>")
    by = {(r.vec_id, r.component): r for r in whitening.whiten(line).collect()}
    assert all(by[i, 2].whitened is None for i in range(5)) and by[0, 1].identity_error < 1e-9
    assert abs(sum(by[i, 1].whitened ** 2 for i in range(5)) / 5 - 1) < 1e-9


def test_large_values_stay_exact(spark):
    rows = [(1, [2.0 ** 55, 1.0]), (2, [1.0, -(2.0 ** 55)]), (3, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = whitening.whiten(df).collect()
    assert len(out) == 6 and all(r.deviation is None for r in out)  # over a long
    assert all(np.isfinite(r.whitened) for r in out)


@pytest.mark.parametrize("d", [1, 2, 5, 40])
def test_spectrum(d):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((3 * d + 3, d)) * 10.0 ** rng.integers(-3, 3, d)
    v = a.T @ a
    e, p = whitening.components_of(v, d)
    assert np.abs(e - np.linalg.eigvalsh(v)[::-1]).max() < 1e-12 * e[0]
    assert np.abs(p.T @ p - np.eye(d)).max() < 1e-12 and np.abs(v @ p - p * e).max() < 1e-12 * e[0]


def test_equal_eigenvalues():
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((6, 6)))[0]
    v = q @ np.diag([5.0, 5, 5, 2, 2, 0]) @ q.T
    e, p = whitening.components_of(v, 6)
    assert np.allclose(e, [5, 5, 5, 2, 2, 0], atol=1e-12) and np.allclose(v @ p, p * e, atol=1e-12)
