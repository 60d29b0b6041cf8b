import datetime as dt

from pyspark.sql import functions as F

from panelkit.session import work_dir
from panelkit.sources import snapshots as S
from panelkit.sources.api_pages import flatten_pages
from panelkit.sources.html import first_table_rows

d = dt.date


def test_latest_snapshot_floor_gives_zero_rows(spark):
    df = spark.createDataFrame([(1, d(2025, 1, 18)), (2, d(2025, 1, 20))], "v int, dt date")
    assert S.latest_snapshot(df, "2025-01-20").count() == 0
    df2 = df.union(spark.createDataFrame([(3, d(2025, 2, 1)), (4, d(2025, 2, 8))], "v int, dt date"))
    assert [r.v for r in S.latest_snapshot(df2, "2025-01-20").collect()] == [4]


def test_latest_snapshot_prunes_partitions(spark):
    root = work_dir(spark, "t_snap")
    df = spark.createDataFrame([(1, d(2025, 1, 18), "en"), (2, d(2025, 2, 1), "en"), (3, d(2025, 2, 8), "en")],
                               "v int, dt date, lang string")
    S.land(df, root, fmt="parquet")
    back = spark.read.parquet(root)
    q = S.latest_snapshot(back, "2025-01-20")
    assert [r.v for r in q.collect()] == [3]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "= Subquery subquery" in plan


def test_snapshot_pick_month_crossing(spark):
    av = spark.createDataFrame([("econ", d(2025, 7, 29)), ("econ", d(2025, 7, 26))], "source string, snapshot_date date")
    got = S.snapshot_pick_as_of(av, "2025-08-01").collect()
    assert [(r.picked_date, r.friday) for r in got] == [(d(2025, 7, 29), d(2025, 8, 1))]
    only_old = av.where(F.col("snapshot_date") == d(2025, 7, 26))
    assert S.snapshot_pick_as_of(only_old, "2025-08-01").count() == 0
    per_friday = {r.friday: r.picked_date for r in S.snapshot_pick(av).collect()}
    assert per_friday == {d(2025, 8, 1): d(2025, 7, 29)}  # 07-26 is a Saturday: 6 days before its Friday


def test_html_first_table(spark):
    html = ("<html><table><tr><th>Start Date</th><th>Approving</th></tr>"
            "<tr><td>1/2/21</td><td>40</td></tr><tr><td>1/3/21</td></tr>"
            "<tr><td>1/4/21</td><td>50</td><td>extra</td></tr></table>"
            "<table><tr><th>x</th></tr><tr><td>decoy</td></tr></table></html>")
    pages = spark.createDataFrame([("a", html), ("b", "<html><p>no table</p></html>")], "k string, html string")
    rows = first_table_rows(pages, ["k"], columns=["Start Date", "Approving"]).orderBy("row_no").collect()
    assert [(r.k, r["Start Date"], r.Approving) for r in rows] == [
        ("a", "1/2/21", "40"), ("a", "1/3/21", None), ("a", "1/4/21", "50")]


def test_api_pages_flatten(spark):
    from pyspark.sql.types import StringType, StructField, StructType
    rec = StructType([StructField("n", StringType())])
    pages = spark.createDataFrame([('{"results":[{"n":"1"},{"n":"2"}],"next_page_url":"p2"}',),
                                   ('{"results":[{"n":"3"}]}',)], "body string")
    out = flatten_pages(pages, "body", rec).collect()
    assert sorted(r.n for r in out) == ["1", "2", "3"]
    assert sum(r.is_last_page for r in out) == 1


def test_append_run_rejects_schema(spark):
    import pytest
    from pyspark.sql.types import LongType, StructField, StructType
    expected = StructType([StructField("a", LongType())])
    with pytest.raises(S.SchemaMismatch):
        S.append_run(spark.createDataFrame([("x",)], "a string"), work_dir(spark, "t_runs"), expected)


def test_landed_page_files_multiline(spark):
    import json
    import os

    from pyspark.sql.types import StringType, StructField, StructType

    from panelkit.sources.api_pages import flatten_page_files, page_schema
    root = work_dir(spark, "t_pages")
    if "://" not in root:
        for i, recs in enumerate([[{"n": "1"}, {"n": "2"}], [{"n": "3"}]]):
            with open(os.path.join(root, f"page-{i}.json"), "w") as fh:
                json.dump({"results": recs, "next_page_url": None if i else "p2"}, fh, indent=2)
    rec = StructType([StructField("n", StringType())])
    df = spark.read.schema(page_schema(rec)).option("multiLine", True).json(root)
    assert sorted(r.n for r in flatten_page_files(df).collect()) == ["1", "2", "3"]


def test_html_duplicate_and_missing_headers(spark):
    html = ("<table><tr><th>A</th><th>A</th><th></th></tr><tr><td>1</td><td>2</td><td>3</td></tr></table>")
    pages = spark.createDataFrame([("p", html)], "k string, html string")
    r = first_table_rows(pages, ["k"], columns=["A", "B"]).first()
    assert (r.A, r.B) == ("1", None)


def test_html_pages_without_tables_give_no_rows(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select(F.col("url").alias("k"), "html")
    assert first_table_rows(pages, ["k"], columns=["Start Date"]).count() == 0
    none = spark.createDataFrame([("x", "<p>none</p>"), ("y", None)], "k string, html string")
    assert first_table_rows(none, ["k"]).count() == 0


def test_csv_header_order_mismatch_fails_loudly(spark):
    import pytest
    from pyspark.sql.types import StringType, StructField, StructType
    root = work_dir(spark, "t_csv")
    df = spark.createDataFrame([("1", "2", d(2025, 2, 8), "en")], "b string, a string, dt date, lang string")
    S.land(df, root, fmt="csv")
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    with pytest.raises(Exception):
        S.read_snapshots(spark, root, schema, fmt="csv").collect()
    ok = StructType([StructField("b", StringType()), StructField("a", StringType())])
    r = S.read_snapshots(spark, root, ok, fmt="csv").first()
    assert (r.a, r.b) == ("2", "1")


def test_newest_snapshot_is_found_without_reading_files(spark):
    """The date comes from the folder listing: no subquery over the files, NULL dates left out."""
    from pyspark.sql.types import IntegerType, StructField, StructType
    schema = StructType([StructField("v", IntegerType())])
    for fmt in ("parquet", "json", "csv"):
        root = work_dir(spark, "t_newest")
        df = spark.createDataFrame([(1, d(2025, 1, 18), "en"), (2, d(2025, 2, 1), "en"), (3, d(2025, 2, 8), "en"),
                                    (9, None, "en")], "v int, dt date, lang string")
        S.land(df, root, fmt=fmt)
        assert S.partition_dates(spark, root) == [d(2025, 1, 18), d(2025, 2, 1), d(2025, 2, 8)]
        q = S.read_latest_snapshot(spark, root, schema, fmt, "2025-01-20")
        assert [(r.v, r.dt) for r in q.collect()] == [(3, d(2025, 2, 8))]
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "Subquery" not in plan and "PartitionFilters: [isnotnull(dt" in plan
        assert S.read_latest_snapshot(spark, root, schema, fmt, "2025-02-08").count() == 0
    assert S.partition_dates(spark, work_dir(spark, "t_none")) == []


def test_newest_run_and_stored_schema(spark):
    import pytest
    path = work_dir(spark, "t_runs")
    for v, ts in ((1, "2025-02-01 09:00:00"), (2, "2025-02-08 06:00:00"), (3, "2025-02-08 12:00:00")):
        S.append_run(spark.createDataFrame([(v,)], "v int").withColumn(
            "run_date", F.lit(ts).cast("timestamp_ntz")), path)
    assert [tuple(r) for r in S.read_latest_run(spark, path).collect()] == [(3,)]
    run = F.lit("2025-02-09 00:00:00").cast("timestamp_ntz").alias("run_date")
    for other in ("cast(1 AS bigint) AS v", "1 AS v, 2 AS w", "1 AS w"):
        with pytest.raises(S.SchemaMismatch):
            S.append_run(spark.sql(f"SELECT {other}").select("*", run), path)
