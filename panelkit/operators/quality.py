"""Data-quality audits on a panel: null rows, calendar gaps, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.constants import COLLINEAR_THRESHOLD
from panelkit.functions.cleaning import any_null


def null_audit(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Per key: total rows, rows with any NULL among ``cols``, NULLs per column."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(any_null(cols)).alias("n_null_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols])


def gap_report(df: DataFrame, keys: Sequence[str] = (), week_col: str = "week_start") -> DataFrame:
    """Missing weeks per key: the spine can lose whole months (presence filter),
    after which a lag of 52 rows is no longer one year."""
    w = F.col(week_col)
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_weeks"), F.min(w).alias("first_week"), F.max(w).alias("last_week"))
            .withColumn("expected_weeks", (F.datediff("last_week", "first_week") / 7 + 1).cast("bigint"))
            .withColumn("missing_weeks", F.col("expected_weeks") - F.col("n_weeks")))


def corr_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Pairwise Pearson correlation (pairwise-complete rows) for every i < j pair.

    Each panel row is unpivoted to its pairs of values, a fixed number, and one
    aggregate with map-side combine runs over (series, pair): one read of the
    frame, small generated code, parallel over series and pairs. NULL, not an
    ANSI division error or NaN, when either side is constant.
    """
    names = [F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"), F.col(a).cast("double").alias("x"),
                      F.col(b).cast("double").alias("y")) for a, b in combinations(cols, 2)]
    long = df.select(*keys, F.explode(F.array(*names)).alias("_p")).select(*keys, "_p.*")
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    spread = F.stddev_samp(F.when(both, F.col("x"))) * F.stddev_samp(F.when(both, F.col("y")))
    return long.groupBy(*keys, "var_x", "var_y").agg(F.try_divide(F.covar_samp("x", "y"), spread).alias("corr"))


def collinear_pairs(corr: DataFrame, threshold: float = COLLINEAR_THRESHOLD) -> DataFrame:
    """Pairs whose absolute correlation exceeds ``threshold`` (strict)."""
    return corr.where(F.abs(F.col("corr")) > threshold)
