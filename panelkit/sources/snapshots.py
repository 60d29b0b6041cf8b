"""Snapshot-partitioned landing tables and run-stamped append tables.

Layout: ``<root>/dt=YYYY-MM-DD/lang=en/part-*`` (Hive style). Reads pass an
explicit schema so ``dt`` is a DATE from partition discovery and nothing is
inferred. For a stored root the newest snapshot or run day is taken from the
folder listing and becomes a literal partition filter, so only its files are
read (``read_latest_snapshot``, ``read_latest_run``). For any other DataFrame it
is a scalar subquery over the date column (``latest_snapshot``, ``latest_run``).

Text lands compressed, in files of a bounded number of records: such a file is
read whole by one task. A landing task writes its rows as they come, with a
file open for each of a few partitions, instead of sorting them on disk.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from panelkit.constants import SNAPSHOT_FLOOR, SNAPSHOT_LOOKBACK_DAYS, SNAPSHOT_WEEKDAY
from panelkit.functions.dates import date_label, most_recent_friday, slash_to_dash

PARTITION_FIELDS = [StructField("dt", DateType()), StructField("lang", StringType())]


def _date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


# ------------------------------------------------------------------ landing

#: Partitions for which a task holds a file open at once; a task with rows of more sorts the rest.
OPEN_FILES = 4
#: Records in a landed text file at most.
FILE_RECORDS = 1_000_000
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def open_files(spark: SparkSession, n: int = OPEN_FILES) -> Iterator[None]:
    """Partitioned writes inside need no sort of their rows: a task holds up to ``n`` files open.

    A session that states a number of its own keeps it.
    """
    if spark.conf.get(_WRITERS, None) is not None:
        yield
        return
    spark.conf.set(_WRITERS, str(n))
    try:
        yield
    finally:
        spark.conf.unset(_WRITERS)


def land(df: DataFrame, root: str, fmt: str = "json", mode: str = "append",
         partition_cols: Sequence[str] = ("dt", "lang")) -> None:
    """Write records under ``dt=/lang=`` partitions (NDJSON or CSV with header, both as gzip, or Parquet)."""
    if fmt not in ("json", "csv", "parquet"):
        raise ValueError(fmt)
    w = df.write.mode(mode).partitionBy(*partition_cols)
    if fmt != "parquet":
        w = (w.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
             .option("maxRecordsPerFile", FILE_RECORDS))
    with open_files(df.sparkSession):
        if fmt == "json":
            w.option("dateFormat", "yyyy-MM-dd").json(root)
        elif fmt == "csv":
            w.option("header", True).csv(root)
        else:
            w.parquet(root)


def read_snapshots(spark: SparkSession, root: str, schema: StructType, fmt: str = "json",
                   multiline: bool = False) -> DataFrame:
    """Read a landed root with an explicit data schema plus ``dt DATE, lang STRING``."""
    full = StructType(list(schema.fields) + PARTITION_FIELDS)
    r = spark.read.schema(full)
    if fmt == "json":
        r = r.option("multiLine", multiline)
    elif fmt == "csv":
        # validate every file's header against the schema (a different column
        # order fails loudly instead of being read by position)
        r = r.option("header", True).option("enforceSchema", False)
    return r.format(fmt).load(root)


# ------------------------------------------------------------ newest picks

def partition_dates(spark: SparkSession, root: str, column: str = "dt", under: str = "") -> list[_dt.date]:
    """Dates of the ``column=`` folders of a written root: a folder listing, no file is opened.

    ``under`` is a glob for folders in between. Folders that name no date are
    left out; a root that is missing or empty gives no dates. One entry per
    snapshot or run day, however many files these hold.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(
        "/".join([root.rstrip("/"), *([under] if under else []), f"{column}=*"]))
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dates = set()
    for status in fs.globStatus(pattern) or []:
        try:
            dates.add(_dt.date.fromisoformat(status.getPath().getName().partition("=")[2]))
        except ValueError:  # the folder of NULL
            continue
    return sorted(dates)


def last_after(dates: Sequence[_dt.date], floor=None) -> _dt.date | None:
    """The last date strictly after ``floor``."""
    if isinstance(floor, str):
        floor = _dt.date.fromisoformat(floor)
    return max((d for d in dates if floor is None or d > floor), default=None)


def newest_after(dates: Sequence[_dt.date], floor=None) -> Column:
    """``last_after`` as a literal; NULL, which no row equals, if there is none."""
    return F.lit(last_after(dates, floor)).cast("date")


def read_latest_snapshot(spark: SparkSession, root: str, schema: StructType, fmt: str = "json",
                         floor=SNAPSHOT_FLOOR, multiline: bool = False) -> DataFrame:
    """The newest landed snapshot after ``floor``: its date comes from the listing, only its files are read."""
    newest = newest_after(partition_dates(spark, root), floor)
    return read_snapshots(spark, root, schema, fmt, multiline).where(F.col("dt") == newest)


def read_latest_run(spark: SparkSession, path: str, run_col: str = "run_date", day_col: str = "run_day") -> DataFrame:
    """The newest run of a table written by ``append_run``: only the newest day's files are read."""
    day = newest_after(partition_dates(spark, path, day_col))
    return latest_run(spark.read.parquet(path).where(F.col(day_col) == day), run_col, None).drop(day_col)


def latest_snapshot(df: DataFrame, floor=SNAPSHOT_FLOOR, dt_col: str = "dt") -> DataFrame:
    """Rows of the newest snapshot whose date is strictly after ``floor``.

    No qualifying snapshot -> the scalar is NULL -> zero rows (not an error).
    """
    newest = df.where(F.col(dt_col) > _date(floor)).select(F.max(dt_col)).scalar()
    return df.where(F.col(dt_col) == newest)


def latest_run(df: DataFrame, run_col: str = "run_date", day_col: str | None = "run_day",
               drop: bool = True) -> DataFrame:
    """Rows of the newest run of an append-only table, ``* EXCEPT(run_date)``.

    Two steps so the partition filter prunes: newest ``run_day`` partition
    first, then the newest ``run_date`` inside it.
    """
    if day_col and day_col in df.columns:
        day = df.select(F.max(day_col)).scalar()
        df = df.where(F.col(day_col) == day)
    newest = df.select(F.max(run_col)).scalar()
    out = df.where(F.col(run_col) == newest)
    if drop:
        out = out.drop(run_col, *([day_col] if day_col and day_col in df.columns else []))
    return out


def snapshot_pick(available: DataFrame, date_col: str = "snapshot_date",
                  keys: Sequence[str] = ("source",), lookback_days: int = SNAPSHOT_LOOKBACK_DAYS) -> DataFrame:
    """For every Friday, the latest available snapshot in ``[friday - lookback, friday]``.

    Instead of probing candidate days per Friday (the studied job asked for
    up to six files), each available date is mapped to the one Friday that
    could pick it (the Friday on or after it) and kept when within the
    look-back; then ``max`` per ``(keys, friday)``. One aggregate, no join.
    Real date arithmetic: a look-back crossing a month start works.
    """
    d = F.col(date_col)
    friday = F.date_add(d, F.pmod(F.lit(SNAPSHOT_WEEKDAY) - F.weekday(d), F.lit(7)))
    x = (available.where(d.isNotNull()).withColumn("friday", friday)
         .where(F.datediff("friday", d) <= int(lookback_days)))
    return (x.groupBy(*keys, "friday")
            .agg(F.max(d).alias("picked_date"), F.count(F.lit(1)).alias("n_candidates")))


def snapshot_pick_as_of(available: DataFrame, as_of, date_col: str = "snapshot_date",
                        keys: Sequence[str] = ("source",), lookback_days: int = SNAPSHOT_LOOKBACK_DAYS) -> DataFrame:
    """The pick for the most recent Friday on or before ``as_of`` (the studied job's case)."""
    fri = most_recent_friday(_date(as_of))
    d = F.col(date_col)
    return (available.where((d <= fri) & (d >= F.date_sub(fri, int(lookback_days))))
            .groupBy(*keys).agg(F.max(d).alias("picked_date"))
            .withColumn("friday", fri))


# ---------------------------------------------------------------- manifest

def manifest_part(df: DataFrame, keys: Sequence[str] = ("dt",), number_col: str = "document_number",
                  date_col: str = "publication_date") -> DataFrame:
    """What the manifest needs of some records, per snapshot; parts of the same snapshot can be merged."""
    num = F.col(number_col).try_cast("bigint")
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.max(num).alias("max_number"),
                 F.count_if(F.col(number_col).isNotNull() & num.isNull()).alias("n_bad_numbers"),
                 F.count_if(F.col(number_col).isNull()).alias("n_null_numbers"),
                 F.max(date_col).alias("max_date")))


def merge_parts(parts: DataFrame, keys: Sequence[str] = ("dt",)) -> DataFrame:
    """One part per snapshot from several: counts (``n_``) add up, the largest value of the others stays."""
    values = [c for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*[(F.sum if c.startswith("n_") else F.max)(c).alias(c) for c in values])


def manifest_label(parts: DataFrame) -> DataFrame:
    """The manifest of merged parts: with the file label."""
    return parts.withColumn("label", F.concat_ws("_", F.col("n_records").cast("string"),
                                                 F.col("max_number").cast("string"), date_label("max_date", "yyyyMMdd")))


def manifest(df: DataFrame, keys: Sequence[str] = ("dt",), number_col: str = "document_number",
             date_col: str = "publication_date") -> DataFrame:
    """Per snapshot: record count, max document number, max date, rejects, file label."""
    return manifest_label(manifest_part(df, keys, number_col, date_col))


LONG_DATE_PREFIX = r"^\d{1,2}/\d{1,2}/\d{4}"


def latest_raw_date(df: DataFrame, raw_col: str = "start_date", keys: Sequence[str] = ()) -> DataFrame:
    """Latest well-formed ``M/d/yyyy`` raw date, returned as the original text.

    Texts that begin like a date are ordered by the date they parse to; the text
    itself is returned, and once more with dashes for file labels. Prefix matches with
    trailing junk fail the parse and are counted, not raised.
    """
    raw = F.col(raw_col)
    ok = raw.rlike(LONG_DATE_PREFIX)
    parsed = F.try_to_date(raw, "M/d/yyyy")
    return (df.groupBy(*keys)
            .agg(F.max_by(F.when(ok & parsed.isNotNull(), raw), F.when(ok, parsed)).alias("latest_raw"),
                 F.count_if(ok).alias("n_well_formed"),
                 F.count_if(ok & parsed.isNull()).alias("n_unparsable"))
            .withColumn("latest_label", slash_to_dash(F.col("latest_raw"))))


# ------------------------------------------------------- fixed-schema tables

class SchemaMismatch(ValueError):
    pass


def check_schema(df: DataFrame, expected: StructType) -> DataFrame:
    """Select ``expected``'s columns by name, cast-free; reject missing or differently typed ones."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"{f.name}: {have.get(f.name)} != {f.dataType}" for f in expected.fields
                if have.get(f.name) != f.dataType]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.select(*[f.name for f in expected.fields])


def append_run(df: DataFrame, path: str, expected: StructType | None = None,
               run_col: str = "run_date", day_col: str = "run_day") -> None:
    """Append one complete run, partitioned by the run's day (create-if-absent).

    The run must have the columns and types of the table on disk, if there is one.
    """
    if expected is not None:
        df = check_schema(df, expected)
    if partition_dates(df.sparkSession, path, day_col):
        stored = df.sparkSession.read.parquet(path).drop(day_col).schema
        extra = sorted(set(df.columns) - set(stored.names))
        if extra:
            raise SchemaMismatch(f"not in the stored table: {', '.join(extra)}")
        df = check_schema(df, stored)
    (df.withColumn(day_col, F.to_date(F.col(run_col)))
       .write.mode("append").partitionBy(day_col).parquet(path))


def overwrite_table(df: DataFrame, path: str, sort_cols: Sequence[str] = ()) -> None:
    """``CREATE OR REPLACE TABLE ... AS``; optional sort within files (order is not a contract)."""
    if sort_cols:
        df = df.sortWithinPartitions(*sort_cols)
    df.write.mode("overwrite").parquet(path)
