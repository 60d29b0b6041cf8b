"""The modelling preparation on one long series: every row of ``events`` in the order of its time."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import longseries as L
from panelkit.plans import fixtures as FX
from panelkit.plans import oracles_model as OM
from panelkit.plans.registry import register

ORDER = ["ts", "event_id"]
S_CTE = """s AS (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events),
st AS (SELECT median(value) AS med, stddev_samp(value) AS sd FROM s)"""


def series(spark, sf):
    return L.positions(FX.table(spark, sf, "events").select("ts", "event_id", "value"), ORDER)


@register("difference_single", f"""WITH {S_CTE} SELECT event_id, pos,
  round(value - lag(value) OVER (ORDER BY pos), 6) AS value_diff FROM s""", covers="P7 (one long series)")
def q_difference_single(spark, sf):
    return L.difference(series(spark, sf), "value").select("event_id", L.POS, F.round("value_diff", 6).alias("value_diff"))


@register("decompose_single", f"""WITH {S_CTE},
d AS (SELECT *, pos % 52 AS phase, CASE WHEN count(value) OVER w = 53 THEN
        (sum(value) OVER w - 0.5 * lag(value, 26) OVER (ORDER BY pos) - 0.5 * lead(value, 26) OVER (ORDER BY pos)) / 52 END AS trend
      FROM s WINDOW w AS (ORDER BY pos ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING)),
p AS (SELECT phase, avg(value - trend) AS mean FROM d GROUP BY phase),
q AS (SELECT phase, mean - (SELECT avg(mean) FROM p) AS seasonal FROM p)
SELECT event_id, pos, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
       round(value - trend - seasonal, 4) AS resid FROM d JOIN q USING (phase)""", covers="P8 P9 P10 (one long series)")
def q_decompose_single(spark, sf):
    d = L.decompose(series(spark, sf), "value", 52)
    return d.select("event_id", L.POS, F.round("trend", 6).alias("trend"), F.round("seasonal", 6).alias("seasonal"),
                    F.round("resid", 4).alias("resid"))


@register("outlier_single", f"""WITH {S_CTE} SELECT event_id, pos, abs(value - med) > 3 * sd AS is_outlier,
  CASE WHEN abs(value - med) > 3 * sd THEN med ELSE value END AS value FROM s, st""", covers="P11 A7 X6 (one long series)")
def q_outlier_single(spark, sf):
    return L.outlier_blank(series(spark, sf), "value").select("event_id", L.POS, "is_outlier", "value")


#: The spline's oracle reads ``ob``: one series, one variable, x in days that are ``_epoch_weeks`` times seven.
SPLINE_SQL = OM.recursive(f"""WITH {S_CTE},
ob AS (SELECT 'all' AS series_key, DATE '1970-01-04' + CAST(7 * pos AS INTEGER) AS week_start, event_id, pos,
              CASE WHEN abs(value - med) > 3 * sd THEN NULL ELSE value END AS value FROM s, st),
{", ".join(OM.spline_ctes(["value"]))}
""") + """SELECT event_id, pos, round(f, 6) AS value FROM ob JOIN filled USING (series_key, week_start)"""


@register("interpolate_spline_single", SPLINE_SQL, covers="P12 (spline, one long series)")
def q_interpolate_spline_single(spark, sf):
    """Outliers of the series are blanked, the gaps filled by the spline through all other values."""
    s = series(spark, sf)
    marked = L.outlier_blank(s.withColumn("_v", F.col("value")), "_v").withColumn("value", F.when(~F.col("is_outlier"), F.col("value")))
    return L.interpolate_spline(marked.select("event_id", L.POS, "value"), "value") \
        .select("event_id", L.POS, F.round("value", 6).alias("value"))
