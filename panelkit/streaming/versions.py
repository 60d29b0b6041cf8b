"""Tables as immutable versions with a commit marker each.

``<root>/v=<number>`` holds a version, and the empty file ``<root>/_commits/<number>`` makes it the current one.
A version is written whole before its marker is created, in one step that every file system does at once, and
neither is changed afterwards. So a reader finds the last committed version at any time: while the next one is
written, and after a crash between its write and its commit, which a replay overwrites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"


def _files(spark: SparkSession, path: str):
    """Spark's own file system for a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def folder(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:010d}"


def _marker(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{COMMITS}/{version:010d}"


def committed(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, ascending: a listing of small names."""
    fs, pattern = _files(spark, f"{root.rstrip('/')}/{COMMITS}/*")
    names = [s.getPath().getName() for s in fs.globStatus(pattern) or []]
    return sorted(int(n) for n in names if n.isdigit())


def applied(spark: SparkSession, root: str, version: int) -> bool:
    """Whether this version or a later one is committed."""
    return version <= max(committed(spark, root), default=-1)


def write(df: DataFrame, root: str, version: int) -> None:
    """Write a version that isn't committed; what an earlier try has left is overwritten."""
    if applied(df.sparkSession, root, version):
        raise ValueError(f"version {version} of {root} is committed")
    df.write.mode("overwrite").parquet(folder(root, version))


def commit(spark: SparkSession, root: str, version: int) -> None:
    fs, marker = _files(spark, _marker(root, version))
    fs.create(marker, True).close()


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """The last committed version, None before the first."""
    versions = committed(spark, root)
    return spark.read.parquet(folder(root, versions[-1])) if versions else None


def prune(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the last ``keep`` committed versions; readers of these go on undisturbed."""
    for version in committed(spark, root)[:-max(1, keep)]:
        for path in (_marker(root, version), folder(root, version)):  # the marker first
            fs, where = _files(spark, path)
            fs.delete(where, True)
