import datetime as dt

from pyspark.sql import functions as F

from panelkit.operators import panel as P

d = dt.date
IND = {c: ("100" if c in P.INDICATORS_NA else 7) for c in P.INDICATORS}


def indicators(spark, rows):
    schema = ", ".join(["Month string", "Year string"] +
                       [f"{c} {'string' if c in P.INDICATORS_NA else 'bigint'}" for c in P.INDICATORS])
    data = [(m, y, *[ov.get(c, IND[c]) for c in P.INDICATORS]) for m, y, ov in rows]
    return P.curate_indicators(spark.createDataFrame(data, schema)).select("month_start", *P.INDICATORS)


def test_fanout_reference_and_corrected(spark):
    # week of Sunday 2025-01-05: 3 events on the 6th and 1 on the 8th; 3 January polls (40, 50, n/a)
    ev = spark.createDataFrame([(d(2025, 1, 6),)] * 3 + [(d(2025, 1, 8),)], "publication_date date")
    ev = P.events_by_date(ev)
    polls = spark.createDataFrame([("1/2/25", None, "40", "1", "1", "x"), ("1/3/2025", None, "50", "1", "1", "x"),
                                   ("1/4/25", None, "n/a", "1", "1", "x")],
                                  "start_date string, end_date string, approving string, disapproving string, "
                                  "unsure_or_no_data string, president string")
    ind = indicators(spark, [("1", "2025", {}), ("2", "2025", {"ConstructionSpending": "NA"})])
    ref = P.weekly_panel(ev, P.curate_polls(polls), ind, "2025-02-02", "2025-02-02 00:00:00")
    rows = {r["week_start"]: r for r in ref.collect()}
    assert rows[d(2025, 1, 5)]["approving"] == 45.0
    assert rows[d(2025, 1, 5)][P.OUTCOME] == 12
    # February: no polls -> approving NULL, outcome unscaled (0 events); 'NA' kept as NULL
    feb = rows[d(2025, 2, 2)]
    assert feb["approving"] is None and feb[P.OUTCOME] == 0 and feb["ConstructionSpending"] is None
    cor = {r["week_start"]: r for r in P.weekly_panel(ev, P.curate_polls(polls), ind, "2025-02-02",
                                                        "2025-02-02 00:00:00", fanout="corrected").collect()}
    assert cor[d(2025, 1, 5)][P.OUTCOME] == 4
    assert set(rows) == {d(2025, 1, 5), d(2025, 1, 12), d(2025, 1, 19), d(2025, 1, 26), d(2025, 2, 2)}


def test_missing_month_drops_weeks(spark):
    ev = P.events_by_date(spark.createDataFrame([(d(2025, 1, 6),)], "publication_date date"))
    polls = spark.createDataFrame([], "start_date string, end_date string, approving string, disapproving string, "
                                      "unsure_or_no_data string, president string")
    ind = indicators(spark, [("2", "2025", {})])
    out = P.weekly_panel(ev, P.curate_polls(polls), ind, "2025-02-09", "2025-02-09 00:00:00").collect()
    assert sorted(r["week_start"] for r in out) == [d(2025, 2, 2), d(2025, 2, 9)]


def test_fill_weeks_equals_spine_join(spark, sf):
    from panelkit.plans import q_panel
    ev = q_panel.events_sorted(spark, sf)
    weekly = P.week_counts(ev, keys=["series_key"], count_col="events_on_date")
    spine = P.date_spine(P.week_anchor(weekly, ["series_key"]), "2001-11-10", ["series_key"])
    a = spine.join(weekly, ["series_key", "week_start"], "left").select("series_key", "week_start", "n_events")
    b = P.fill_weeks(weekly, "2001-11-10", ["series_key"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_bucketed_range_join_matches_brute_force(spark):
    pts = spark.createDataFrame([(i, d(2025, 1, 1) + dt.timedelta(days=i)) for i in range(60)], "pid int, p date")
    iv = spark.createDataFrame([(0, d(2025, 1, 3), d(2025, 1, 20)), (1, d(2025, 1, 10), d(2025, 1, 10)),
                                (2, d(2025, 2, 1), d(2025, 1, 1)), (3, None, d(2025, 1, 5))],
                               "iid int, lo date, hi date")
    got = sorted((r.iid, r.pid) for r in P.bucketed_range_join(pts, "p", iv, "lo", "hi", 7).collect())
    exp = sorted((r.iid, r.pid) for r in iv.join(pts, (pts.p >= iv.lo) & (pts.p <= iv.hi)).collect())
    assert got == exp and len(got) == 19


def test_bucketed_range_join_left_keeps_each_interval_once(spark):
    pts = spark.createDataFrame([(i, d(2025, 1, 1) + dt.timedelta(days=i % 5)) for i in range(200)], "pid int, p date")
    iv = spark.createDataFrame([(0, d(2025, 1, 3), d(2025, 2, 20)), (1, d(2025, 6, 1), d(2025, 8, 1)),
                                (2, None, d(2025, 1, 5)), (1, d(2025, 6, 1), d(2025, 8, 1))],
                               "iid int, lo date, hi date")
    key = lambda r: (r.iid, str(r.lo), -1 if r.pid is None else r.pid)
    exp = sorted(map(key, iv.join(pts, (pts.p >= iv.lo) & (pts.p <= iv.hi), "left").collect()))
    for most in (1, 7, 1000):
        got = P.bucketed_range_join(pts, "p", iv, "lo", "hi", 7, how="left", points_per_part=most).collect()
        assert sorted(map(key, got)) == exp


def test_a_hot_day_is_split_by_its_weight(spark, monkeypatch):
    monkeypatch.setattr(P, "LEAST_SHARE", 100)
    hot = spark.range(40_000).select(F.col("id").alias("pid"), F.when(F.col("id") % 2 == 0, F.lit(d(2025, 3, 5))).otherwise(
        F.date_add(F.lit(d(2025, 1, 1)), (F.col("id") % 300).cast("int"))).alias("p"))
    parts = {r["_bucket"]: r["_parts"] for r in P.bucket_parts(
        hot.withColumn("_bucket", F.floor(F.datediff("p", F.lit(d(1970, 1, 1))) / 7).cast("long")), ["_bucket"], 1000).collect()}
    assert len(parts) == 1 and 20 <= list(parts.values())[0] <= 22  # only the hot week, by its own count
    iv = spark.createDataFrame([(i, d(2025, 1, 1) + dt.timedelta(days=7 * i), d(2025, 1, 9) + dt.timedelta(days=7 * i))
                                for i in range(60)], "iid int, lo date, hi date")
    out = P.bucketed_range_join(hot, "p", iv, "lo", "hi", 7, points_per_part=1000)
    exp = iv.join(hot, (hot.p >= iv.lo) & (hot.p <= iv.hi))
    assert sorted((r.iid, r["count"]) for r in out.groupBy("iid").count().collect()) == \
        sorted((r.iid, r["count"]) for r in exp.groupBy("iid").count().collect())
    assert out.distinct().count() == out.count()


def test_panel_plan_has_no_nested_loop_or_cartesian(spark, sf):
    from panelkit.plans import q_panel
    df = q_panel.panel(spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # events once, indicators once, and the spine's end, whose shuffle is the events' own when it runs
    assert plan.count("lineitem.parquet") == 3
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final
    assert F is not None


def test_duplicate_indicator_month_is_an_input_error(spark):
    import pytest
    ev = P.events_by_date(spark.createDataFrame([(d(2025, 1, 6),)], "publication_date date"))
    polls = spark.createDataFrame([], "start_date string, end_date string, approving string, disapproving string, "
                                      "unsure_or_no_data string, president string")
    ind = indicators(spark, [("1", "2025", {}), ("1", "2025", {"BusinessApplications": 8})])
    with pytest.raises(Exception, match="duplicate indicator month"):
        P.weekly_panel(ev, P.curate_polls(polls), ind, "2025-01-12", "2025-01-12 00:00:00").collect()
    lit = P.weekly_panel(ev, P.curate_polls(polls), ind, "2025-01-12", "2025-01-12 00:00:00",
                         validate_months=False).collect()
    assert len(lit) == 4  # 2 weeks x 2 indicator rows, as the literal query groups them


def test_single_series_panel_scans_events_once(spark, sf):
    from panelkit.plans import fixtures as FX
    from panelkit.plans import q_panel
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = P.weekly_panel(FX.fx_events(spark, sf), q_panel.polls_sorted(spark, sf),
                           q_panel.indicators_sorted(spark, sf), FX.AS_OF, FX.RUN_TS)
        plan = p._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("lineitem.parquet") == 2 and "ReusedExchange" in plan  # events once, indicators once


def test_spine_ends_with_the_last_event_of_any_series(spark):
    ev = spark.createDataFrame([("a", d(2025, 1, 6)), ("a", d(2025, 1, 20)), ("b", d(2025, 1, 7)), ("b", None)],
                               "k string, publication_date date")
    out = P.fill_weeks(P.week_counts(ev, keys=["k"]), None, ["k"])
    weeks = [d(2025, 1, 5), d(2025, 1, 12), d(2025, 1, 19)]
    assert sorted((r.k, r.week_start, r.n_events) for r in out.collect()) == [
        *[("a", w, n) for w, n in zip(weeks, (1, None, 1))], *[("b", w, n) for w, n in zip(weeks, (1, None, None))]]
    one = P.spine_join(P.week_counts(ev), None).collect()
    assert sorted((r.week_start, r.n_events) for r in one) == list(zip(weeks, (2, None, 1)))
    none = ev.where("k = 'c'")
    assert P.fill_weeks(P.week_counts(none, keys=["k"]), None, ["k"]).count() == 0
    assert P.spine_join(P.week_counts(none), None).count() == 0
