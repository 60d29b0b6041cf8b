"""Standardisation and principal components, per series.

PCA is done in two steps that scale with the data:

1. one distributed aggregate per series: ``n``, column sums and the upper
   triangle of cross-products (the Gram matrix) - partial aggregation, so a
   hot series costs no more shuffle than a cold one;
2. a grouped-map function per series receives that single row
   (p*(p+1)/2 numbers), builds the covariance matrix and eigendecomposes it
   with NumPy.

Scores are plain column arithmetic after joining each series' loadings (one
row per series) back onto its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.constants import PCA_VARIANCE_TARGET


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join per-key statistics (one row per key) back onto rows.

    Without keys the statistic is one global row of summary numbers (means,
    deviations, loadings: tens to hundreds of values). It is read once and
    inlined as literals, so no join - and no nested-loop or cartesian plan -
    is needed. ``how='inner'`` then drops everything when it is missing.
    """
    if keys:
        return df.join(stats, list(keys), how)
    rows = stats.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("a keyless statistic must have exactly one row")
    if not rows:
        if how == "inner":
            return df.where(F.lit(False)).select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                                         for f in stats.schema.fields])
        return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in stats.schema.fields])
    row = rows[0]
    return df.select("*", *[_literal(row[f.name], f.dataType).alias(f.name) for f in stats.schema.fields])


def _literal(v, dtype):
    from pyspark.sql.types import MapType
    if v is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, MapType):
        if not v:
            return F.create_map().cast(dtype)
        return F.create_map(*[F.lit(x) for kv in v.items() for x in kv]).cast(dtype)
    return F.lit(v).cast(dtype)


def standardize(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
                suffix: str = "") -> DataFrame:
    """``(x - mean) / population std`` per series; a constant column becomes 0.

    Population sigma (ddof = 0), not Spark ML's ``StandardScaler`` (sample sigma).
    """
    if keys:  # one pass: whole-partition windows per series (a series is bounded by its weeks)
        w = Window.partitionBy(*keys)
        j = df.select("*", *[F.avg(c).over(w).alias(f"_m_{c}") for c in cols],
                      *[F.stddev_pop(c).over(w).alias(f"_s_{c}") for c in cols])
    else:
        stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                       *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
        j = attach(df, stats, keys)
    z = [F.when(F.col(f"_s_{c}") == 0, F.lit(0.0))
         .otherwise((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).alias(c + suffix) for c in cols]
    keep = [c for c in df.columns if suffix or c not in cols]
    return j.select(*keep, *z)


def gram(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Per series: ``n``, ``s_i = sum x_i``, ``g_i_j = sum x_i x_j`` (i <= j) over complete rows."""
    complete = df.where(F.lit(True) if not cols else
                        F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in cols)))
    p = len(cols)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(c).alias(f"s_{i}") for i, c in enumerate(cols)]
    aggs += [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"g_{i}_{j}") for i in range(p) for j in range(i, p)]
    return complete.groupBy(*keys).agg(*aggs)


def _cov_from_row(row, p: int):
    n = float(row["n"])
    s = np.array([row[f"s_{i}"] for i in range(p)], dtype=float)
    g = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            g[i, j] = g[j, i] = row[f"g_{i}_{j}"]
    mean = s / n
    cov = (g - n * np.outer(mean, mean)) / (n - 1)
    return mean, cov


def pca_model(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long table ``(keys, component, feature, loading, mean, eigenvalue, ratio)``.

    Components sorted by eigenvalue (descending); the sign of each component
    makes its largest-magnitude loading positive (deterministic, like the
    common SVD sign convention).
    """
    cols = list(cols)
    keys = list(keys)
    p = len(cols)
    g = gram(df, cols, keys)
    key_fields = [f for f in g.schema.fields if f.name in keys]
    schema = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_fields)
              + (", " if key_fields else "")
              + "component int, feature string, loading double, mean double, eigenvalue double, ratio double")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        out_rows = []
        if row["n"] < 2:
            return pd.DataFrame(columns=[*keys, "component", "feature", "loading", "mean", "eigenvalue", "ratio"])
        mean, cov = _cov_from_row(row, p)
        vals, vecs = np.linalg.eigh(cov)
        order = np.argsort(vals)[::-1]
        vals, vecs = vals[order], vecs[:, order]
        vals = np.clip(vals, 0.0, None)
        total = vals.sum()
        for k in range(p):
            v = vecs[:, k]
            if v[np.argmax(np.abs(v))] < 0:
                v = -v
            for i, c in enumerate(cols):
                out_rows.append({**{kk: row[kk] for kk in keys}, "component": k + 1, "feature": c,
                                 "loading": float(v[i]), "mean": float(mean[i]),
                                 "eigenvalue": float(vals[k]),
                                 "ratio": float(vals[k] / total) if total > 0 else None})
        return pd.DataFrame(out_rows)

    if not keys:  # one series: the Gram is a single row
        return g.withColumn("_g", F.lit(0)).groupBy("_g").applyInPandas(solve, schema)
    return g.groupBy(*keys).applyInPandas(solve, schema)


def pca_scores(df: DataFrame, model: DataFrame, cols: Sequence[str], k: int,
               keys: Sequence[str] = (), prefix: str = "PC") -> DataFrame:
    """Project rows onto the first ``k`` components: ``PC_j = sum_i (x_i - mean_i) v_ij``."""
    m = model.where(F.col("component") <= k)
    wide = (m.groupBy(*keys)
            .pivot("component", list(range(1, k + 1)))
            .agg(F.map_from_entries(F.collect_list(F.struct("feature", "loading"))).alias("v"),
                 F.map_from_entries(F.collect_list(F.struct("feature", "mean"))).alias("mu")))
    j = attach(df, wide, keys)
    scores = []
    for comp in range(1, k + 1):
        terms = [(F.col(c) - F.col(f"{comp}_mu")[c]) * F.col(f"{comp}_v")[c] for c in cols]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        scores.append(total.alias(f"{prefix}{comp}"))
    return j.select(*df.columns, *scores)


def scree(model: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(component, eigenvalue, ratio, cum_ratio)`` per series."""
    comp = model.select(*keys, "component", "eigenvalue", "ratio").distinct()
    w = Window.partitionBy(*keys).orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return comp.withColumn("cum_ratio", F.sum("ratio").over(w))


def choose_k(scree_df: DataFrame, threshold: float = PCA_VARIANCE_TARGET, keys: Sequence[str] = ()) -> DataFrame:
    """Smallest number of components whose cumulative ratio reaches ``threshold``."""
    return (scree_df.where(F.col("cum_ratio") >= threshold - 1e-12)
            .groupBy(*keys).agg(F.min("component").alias("k")))
