"""Parsed pages as records and rejects of one pass.

A parser gives one row for each record, and one row for each page that has none, with an ``outcome`` that says
which it is: ``record``, ``empty`` (a good page without records) or the reason of a reject. So whatever reads the
parsed rows can account for every page, and nothing is parsed a second time for the rejects.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RECORD, EMPTY = "record", "empty"


def is_reject(outcome: str | Column = "outcome") -> Column:
    c = F.col(outcome) if isinstance(outcome, str) else outcome
    return ~c.isin(RECORD, EMPTY)


def records(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("outcome") == RECORD).drop("outcome")


def rejects(parsed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and the ``reason`` of each page without a result, one row per page."""
    return parsed.where(is_reject()).select(*keep, F.col("outcome").alias("reason"))


@dataclass(frozen=True)
class Landed:
    """A parse written once. ``n_pages`` = pages with records + empty ones + rejects, all counted while writing."""

    path: str
    n_pages: int
    n_records: int
    n_empty: int
    n_rejected: int

    def records(self, spark: SparkSession) -> DataFrame:
        """Only the records' folder is read."""
        return records(spark.read.parquet(self.path))

    def rejects(self, spark: SparkSession, keep: Sequence[str]) -> DataFrame:
        return rejects(spark.read.parquet(self.path), keep)


def land_parsed(parsed: DataFrame, path: str, first: Column) -> Landed:
    """Write ``parsed`` by outcome and count it on the way. ``first`` marks the first row of each page.

    Records and rejects lie in folders of their own, so a reader of either opens nothing else.
    """
    seen = Observation()
    counted = parsed.observe(
        seen, F.count_if(first).alias("n_pages"), F.count_if(F.col("outcome") == RECORD).alias("n_records"),
        F.count_if(F.col("outcome") == EMPTY).alias("n_empty"), F.count_if(is_reject()).alias("n_rejected"))
    counted.write.mode("overwrite").partitionBy("outcome").parquet(path)
    return Landed(path, **seen.get)
