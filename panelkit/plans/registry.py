"""Registry of named queries: a Spark builder plus (optionally) a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: QueryFn
    sql: str | None
    covers: str


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None, covers: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, covers)
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column so engine-level summation order cannot show."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
