"""Paged API envelopes -> flat records.

A landed page is ``{"results": [...], "next_page_url": ...}``; records are the
concatenation of every page's ``results``. With the pages as rows (one file
per page, or one JSON string per row), that is ``explode(results)``: the union
over pages is the DataFrame itself, no driver loop. A page without a results
array is a reject with its reason, a row of the same parse (``outcomes``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from panelkit.sources import outcomes as O

NO_BODY, NO_JSON, NO_RESULTS = "no body", "no JSON", "no results array"
CORRUPT = "_corrupt_record"


def page_schema(record: StructType) -> StructType:
    return StructType([StructField("count", StringType()),
                       StructField("results", ArrayType(record)),
                       StructField("next_page_url", StringType()),
                       StructField(CORRUPT, StringType())])


def _outcome(body: Column | None, results: Column, corrupt: Column) -> Column:
    """What became of a page: the parser itself tells broken JSON apart from an envelope without results."""
    none = F.when(F.lit(False) if body is None else body.isNull(), NO_BODY)
    return (none.when(results.isNotNull() & (F.size(results) > 0), O.RECORD).when(results.isNotNull(), O.EMPTY)
            .when(corrupt.isNotNull(), NO_JSON).otherwise(NO_RESULTS))


def parse_pages(pages: DataFrame, json_col: str, record: StructType, keep: tuple = ()) -> DataFrame:
    """Parse each page once: a row per record, or one row with null record fields for a page that has none.

    ``keep``, ``outcome``, ``is_last_page``, ``record_no`` (from 0 within the page; null without records), then the
    record's fields.
    """
    body = F.col(json_col)
    p = pages.select(*keep, body.isNull().alias("_none"), F.from_json(
        body, page_schema(record), {"columnNameOfCorruptRecord": CORRUPT}).alias("_p"))
    outcome = _outcome(None, F.col("_p.results"), F.col(f"_p.{CORRUPT}"))
    return (p.select(*keep, F.when(F.col("_none"), NO_BODY).otherwise(outcome).alias("outcome"),
                     F.col("_p.next_page_url").isNull().alias("is_last_page"),
                     F.posexplode_outer("_p.results").alias("record_no", "_r"))
            .select(*keep, "outcome", "is_last_page", "record_no", "_r.*"))


def parse_page_files(df: DataFrame) -> DataFrame:
    """``parse_pages`` for pages read with ``spark.read.schema(page_schema(rec)).json(path, multiLine=True)``.

    The page's key is its ``file_path``.
    """
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      _outcome(None, F.col("results"), F.col(CORRUPT)).alias("outcome"),
                      F.col("next_page_url").isNull().alias("is_last_page"),
                      F.posexplode_outer("results").alias("record_no", "_r"))
            .select("file_path", "outcome", "is_last_page", "record_no", "_r.*"))


def first_of_page() -> Column:
    """Marks one row of each parsed page."""
    return F.coalesce(F.col("record_no"), F.lit(0)) == 0


def flatten_pages(pages: DataFrame, json_col: str, record: StructType, keep: tuple = ()) -> DataFrame:
    """The records of all pages, plus ``is_last_page``. ``parse_pages`` has the rejects too."""
    return O.records(parse_pages(pages, json_col, record, keep)).drop("record_no")


def flatten_page_files(df: DataFrame) -> DataFrame:
    """The records of page files. ``parse_page_files`` has the rejects too."""
    return O.records(parse_page_files(df)).drop("file_path", "is_last_page", "record_no")
