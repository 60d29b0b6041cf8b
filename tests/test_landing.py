"""What landing and the ingest's mirror put on disk: compressed text in bounded files, and no sorted copy of the rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter
from pyspark.sql.types import LongType, StringType, StructField, StructType

from panelkit.session import work_dir
from panelkit.sources import snapshots as S
from panelkit.streaming import ingest

KEY = "spark.sql.maxConcurrentOutputFileWriters"
DAYS = [dt.date(2025, 2, d) for d in range(1, 8)]
SCHEMA = StructType([StructField("n", LongType()), StructField("word", StringType())])


def records(spark, n, days):
    """One task's records, the days taking turns (None: no date)."""
    day = F.array(*[F.lit(d).cast("date") for d in days])
    return spark.range(0, n, 1, 1).select(
        F.col("id").alias("n"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("word "), F.col("id") % 5)).alias("word"),
        day[(F.col("id") % len(days)).cast("int")].alias("dt"), F.lit("en").alias("lang"))


def rows(df):
    return sorted((r.n, r.word, str(r.dt), r.lang) for r in df.collect())


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_text_lands_compressed_in_bounded_files(spark, monkeypatch, fmt):
    monkeypatch.setattr(S, "FILE_RECORDS", 10, raising=False)
    root = work_dir(spark, "t_land")
    df = records(spark, 100, [*DAYS[:2], None])
    S.land(df, root, fmt=fmt)
    files = spark.read.text(root).groupBy(F.input_file_name().alias("file")).count().collect()
    assert len(files) == 12 and all(r.file.endswith(f".{fmt}.gz") for r in files)  # 34, 33 and 33 records
    assert max(r["count"] for r in files) == 10 + (fmt == "csv")
    assert rows(S.read_snapshots(spark, root, SCHEMA, fmt)) == rows(df)


def test_compressed_text_is_a_fraction_of_the_raw(spark):
    def size(path):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()

    raw, root = work_dir(spark, "t_raw"), work_dir(spark, "t_land")
    df = records(spark, 20_000, DAYS[:3])
    df.write.mode("append").partitionBy("dt", "lang").json(raw)
    S.land(df, root)
    assert size(root) < size(raw) / 3


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_more_partitions_than_open_files_land_whole(spark, fmt):
    root = work_dir(spark, "t_many")
    df = records(spark, 500, [*DAYS, None])
    assert len(DAYS) > S.OPEN_FILES
    S.land(df, root, fmt=fmt)
    assert rows(S.read_snapshots(spark, root, SCHEMA, fmt)) == rows(df)


def test_open_files_spare_the_sort_and_leave_the_session_as_it_was(spark):
    where = work_dir(spark, "t_explain")
    spark.sql(f"CREATE TABLE t_open_files (n BIGINT, dt DATE) USING json PARTITIONED BY (dt) LOCATION '{where}'")
    try:
        plan = lambda: spark.sql(
            "EXPLAIN INSERT INTO t_open_files SELECT id, date_add(DATE'2025-02-01', CAST(id % 3 AS INT)) FROM range(9)").first()[0]
        assert "Sort [" in plan()
        with S.open_files(spark):
            assert "Sort [" not in plan()
        with pytest.raises(KeyError), S.open_files(spark):
            raise KeyError
        assert spark.conf.get(KEY, None) is None and "Sort [" in plan()
    finally:
        spark.sql("DROP TABLE t_open_files")
    spark.conf.set(KEY, "2")  # a session's own number
    try:
        with S.open_files(spark):
            assert spark.conf.get(KEY) == "2"
        assert spark.conf.get(KEY) == "2"
    finally:
        spark.conf.unset(KEY)


def test_landing_and_mirror_write_with_open_files(spark, monkeypatch):
    seen = []
    for fmt in ("json", "csv", "parquet"):
        def spy(self, path, *args, _write=getattr(DataFrameWriter, fmt), _fmt=fmt, **kwargs):
            if "/landing" in path or "/mirror" in path:
                seen.append((path.split("/t_open")[1].split("/")[1], _fmt, self._spark.conf.get(KEY, None)))
            return _write(self, path, *args, **kwargs)
        monkeypatch.setattr(DataFrameWriter, fmt, spy)
    n = str(S.OPEN_FILES)
    for fmt in ("json", "csv"):
        base = work_dir(spark, "t_open")
        df = records(spark, 60, DAYS[:3])
        S.land(df, f"{base}/landing", fmt=fmt)
        ingest.ingest_available_now(spark, f"{base}/landing", SCHEMA, f"{base}/mirror", f"{base}/curated", f"{base}/manifest",
                                    f"{base}/_ckpt", lambda d: d, fmt=fmt, summarize=ingest.count_part)
        assert seen == [("landing", fmt, n), ("mirror", "parquet", n)]
        seen.clear()
        assert rows(ingest.read_curated(spark, f"{base}/curated")) == rows(df.where(F.col("dt") == DAYS[2]))
        assert spark.conf.get(KEY, None) is None


def test_partitioned_roundtrip_lands_compressed_and_counts_every_record(spark, monkeypatch):
    from panelkit.plans import q_sources as Q
    base, roots = work_dir(spark, "t_roundtrip"), []
    lines = spark.range(0, 90, 1, 2).select(
        F.col("id").alias("l_orderkey"), F.col("id").alias("l_partkey"), (F.col("id") % 7 + 1).alias("l_linenumber"),
        F.when(F.col("id") % 9 > 0, F.lit("A")).alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.expr("date_add(DATE'1996-01-01', CAST(id % 4 AS INT))").alias("l_shipdate"))
    lines.unionAll(lines.limit(5)).write.parquet(f"{base}/lineitem.parquet")
    monkeypatch.setattr(S, "FILE_RECORDS", 10, raising=False)
    monkeypatch.setattr(Q, "work_dir", lambda *a: roots.append(work_dir(*a)) or roots[-1])
    got = {(r.series_key, r.publication_date): r.events_on_date for r in Q.q_partitioned_roundtrip(spark, base).collect()}
    want = {}
    for (i,) in spark.read.parquet(f"{base}/lineitem.parquet").select("l_orderkey").collect():
        key = ("A" if i % 9 else None, dt.date(1996, 1, 8) + dt.timedelta(days=i % 4))  # the newest restates by a week
        want[key] = want.get(key, 0) + 1
    assert got == want and sum(got.values()) == 95
    files = spark.read.text(roots[0]).groupBy(F.input_file_name().alias("file")).count().collect()
    assert sum(r["count"] for r in files) == 3 * 95 and max(r["count"] for r in files) <= 10
    assert all(r.file.endswith(".json.gz") for r in files)
