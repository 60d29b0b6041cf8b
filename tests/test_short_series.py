"""Short series keep their rows through model choice, forecast and run log."""

import numpy as np
from pyspark.sql import functions as F

from panelkit.operators import seasonal as SE


def _panel(spark, weeks):
    rng = np.random.default_rng(2)
    rows = [(k, t, float(rng.normal()), float(50 + rng.normal()), "train" if t < n * 4 // 5 else "test")
            for k, n in weeks.items() for t in range(n)]
    df = spark.createDataFrame(rows, "k string, t_idx int, x double, y double, split string")
    return df.withColumn("week_start", F.date_add(F.lit("2020-01-05").cast("date"), F.col("t_idx") * 7))


def test_every_series_has_a_model_row(spark):
    panel = _panel(spark, {"a": 200, "b": 260, "c": 30})
    grid = SE.seasonal_arx_grid(panel.where("split = 'train'"), "y", ["x"], ["k"]).cache()
    n_eff = {r.k: (r.lo, r.hi, r.n) for r in grid.groupBy("k").agg(
        F.min(F.when(F.col("aic").isNotNull(), F.col("n_eff"))).alias("lo"), F.max("n_eff").alias("hi"),
        F.count("*").alias("n")).collect()}
    # one sample for all fitted candidates of a series, however short
    assert n_eff["a"] == (53, 53, 64) and n_eff["b"][0] == n_eff["b"][1] and n_eff["c"] == (None, 0, 64)
    best = SE.best_model(grid, ["k"])
    rows = {r.k: r for r in best.collect()}
    assert set(rows) == {"a", "b", "c"} and rows["a"].aic is not None
    assert rows["c"].aic is None and rows["c"].error.startswith("insufficient rows")
    # white noise around a level: a second seasonal difference must not win by having fewer rows
    assert rows["b"].sd == 0
    fc = SE.forecast(panel, best, "y", ["x"], ["k"])
    assert {r.k: r.n for r in fc.groupBy("k").agg(F.count("*").alias("n")).collect()} == {"a": 40, "b": 52, "c": 6}
    log = {r.k: r.params for r in SE.run_log(best, "r", "2025-01-01 00:00:00", ["k"]).collect()}
    assert set(log) == {"a", "b", "c"} and "error" in log["c"] and "order" in log["a"]
