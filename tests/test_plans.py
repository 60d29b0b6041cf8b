"""Scale hazards in every registered query's physical plan (static, AQE off)."""

import re

import pytest

import __spark_entry__ as E
from tools.plan_audit import unpartitioned_window


@pytest.fixture(scope="module")
def static_spark(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_nested_loop_cartesian_unpartitioned_window_or_row_udf(static_spark, sf):
    bad = {}
    for name, fn in E.queries().items():
        plan = fn(static_spark, sf)._jdf.queryExecution().executedPlan().toString()
        issues = []
        if "NestedLoopJoin" in plan:
            issues.append("nested-loop join")
        if "CartesianProduct" in plan:
            issues.append("cartesian product")
        if "BatchEvalPython" in plan:
            issues.append("row-at-a-time python udf")
        for ln in plan.splitlines():
            if re.search(r"\bWindow \[", ln) and unpartitioned_window(ln):
                issues.append("window without partition key")
        if issues:
            bad[name] = issues
    assert not bad, bad


def test_stream_manifest_and_idempotence(spark, sf):
    from pyspark.sql import functions as F

    from panelkit.plans import fixtures as FX
    from panelkit.plans.q_sources import EVENT_RECORD
    from panelkit.operators import panel as P
    from panelkit.session import work_dir
    from panelkit.sources import snapshots as S
    from panelkit.streaming.ingest import ingest_available_now, read_curated, read_manifest
    base = work_dir(spark, "t_stream")
    paths = [f"{base}/{p}" for p in ("landing", "mirror", "curated", "manifest", "_ckpt")]
    snaps = FX.fx_event_snapshots(spark, sf)
    curate = lambda df: P.events_by_date(df, keys=["series_key"])
    S.land(snaps.where(F.col("dt") == F.lit("2025-02-08").cast("date")), paths[0])
    ingest_available_now(spark, paths[0], EVENT_RECORD, *paths[1:], curate)
    first = sorted(map(tuple, read_curated(spark, paths[2]).collect()))
    S.land(snaps.where(F.col("dt") == F.lit("2025-02-01").cast("date")), paths[0])   # late, older
    ingest_available_now(spark, paths[0], EVENT_RECORD, *paths[1:], curate)
    ingest_available_now(spark, paths[0], EVENT_RECORD, *paths[1:], curate)            # nothing new
    assert sorted(map(tuple, read_curated(spark, paths[2]).collect())) == first
    man = {str(r.dt): r.n_records for r in read_manifest(spark, paths[3]).collect()}
    expected = {str(r.dt): r["count"] for r in snaps.groupBy("dt").count().collect() if str(r.dt) != "2025-01-18"}
    assert man == expected


def test_stream_csv_source(spark):
    import datetime as dt

    from pyspark.sql.types import StringType, StructField, StructType

    from panelkit.session import work_dir
    from panelkit.sources import snapshots as S
    from panelkit.streaming.ingest import count_part, ingest_available_now, read_curated, read_manifest
    base = work_dir(spark, "t_stream_csv")
    paths = [f"{base}/{p}" for p in ("landing", "mirror", "curated", "manifest", "_ckpt")]
    rows = [(str(i), f"1/{i % 28 + 1}/2025", dt.date(2025, 2, 8), "en") for i in range(20)]
    S.land(spark.createDataFrame(rows, "document_number string, start_date string, dt date, lang string"),
           paths[0], fmt="csv")
    schema = StructType([StructField("document_number", StringType()), StructField("start_date", StringType())])
    ingest_available_now(spark, paths[0], schema, *paths[1:], curate=lambda df: df.drop("dt", "lang"), fmt="csv",
                         summarize=count_part)
    assert read_curated(spark, paths[2]).count() == 20
    assert read_manifest(spark, paths[3], lambda parts: parts).first()["n_records"] == 20
