import datetime as dt

from pyspark.sql import functions as F

from panelkit.operators import panel as P
from panelkit.operators import prep as R
from panelkit.operators import quality as Q
from panelkit.sources import snapshots as S

d = dt.date


def test_spine_empty_when_as_of_before_first_event(spark):
    ev = spark.createDataFrame([("a", d(2025, 3, 3))], "k string, publication_date date")
    weekly = P.week_counts(ev, keys=["k"])
    assert P.fill_weeks(weekly, "2025-01-01", ["k"]).count() == 0
    assert P.spine_join(P.week_counts(ev.drop("k")), "2025-01-01").count() == 0
    assert P.date_spine(P.week_anchor(weekly, ["k"]), "2025-01-01", ["k"]).count() == 0


def test_manifest_counts_bad_and_null_numbers(spark):
    df = spark.createDataFrame([("10", d(2025, 1, 2), d(2025, 2, 8)), ("abc", d(2025, 1, 3), d(2025, 2, 8)),
                                (None, None, d(2025, 2, 8))],
                               "document_number string, publication_date date, dt date")
    r = S.manifest(df).first()
    assert (r.n_records, r.max_number, r.n_bad_numbers, r.n_null_numbers, r.max_date) == (3, 10, 1, 1, d(2025, 1, 3))
    assert r.label == "3_10_20250103"


def test_interpolation_all_null_column_stays_null(spark):
    rows = [("k", d(2020, 1, 5) + dt.timedelta(weeks=i), i, None, float(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "k string, week_start date, t_idx int, x double, y double")
    out = R.interpolate_cubic(df, ["x", "y"], ["k"]).collect()
    assert all(r.x is None for r in out) and sorted(r.y for r in out) == [0, 1, 2, 3, 4, 5]


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([("k", float(i), 1.0, float(-i)) for i in range(5)], "k string, a double, b double, c double")
    got = {(r.var_x, r.var_y): r.corr for r in Q.corr_matrix(df, ["a", "b", "c"], ["k"]).collect()}
    assert got[("a", "b")] is None and abs(got[("a", "c")] + 1) < 1e-12


def test_latest_run_two_step(spark):
    df = spark.createDataFrame([(1, "2025-01-01 10:00:00"), (2, "2025-01-02 08:00:00"), (3, "2025-01-02 09:00:00")],
                               "v int, ts string")
    df = df.select("v", F.col("ts").cast("timestamp_ntz").alias("run_date")).withColumn("run_day", F.to_date("run_date"))
    out = S.latest_run(df).collect()
    assert [r.v for r in out] == [3] and out[0].asDict().keys() == {"v"}


def test_adf_constant_series_is_null_row(spark):
    from panelkit.operators import tsstats as TS
    rows = [("k", i, 5.0) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, t_idx int, x double")
    r = TS.adf(df, "x", ["k"]).first()
    assert r.adf_stat is None and r.p_value is None


def test_best_model_within_differencing(spark):
    import numpy as np

    from panelkit.operators import seasonal as SE
    rng = np.random.default_rng(7)
    n = 300
    y = rng.normal(size=n).cumsum()
    pc = rng.normal(size=n)
    df = spark.createDataFrame([("k", i, float(y[i]), float(pc[i])) for i in range(n)],
                               "k string, t_idx int, y double, PC1 double")
    grid = SE.seasonal_arx_grid(df, "y", ["PC1"], ["k"])
    per = SE.best_model(grid, ["k"], within_differencing=True).collect()
    one = SE.best_model(grid, ["k"]).first()
    assert 1 <= len(per) <= 4 and len({(r.d, r.sd) for r in per}) == len(per)
    assert one.aic == min(r.aic for r in per)
