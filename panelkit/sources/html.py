"""First HTML table of a page -> rows keyed by the page, with built-in functions.

A page is cut at its ``<table>`` and ``</table>`` tags, and one fold over these
tags keeps the nesting depth: what lies at depth 1 of the first table is the
table's own, what lies deeper is text of the cell around it, and the fold ends
where the depth is back at 0. The first row supplies the header, every other
row becomes a record (short rows padded with NULL, extra cells dropped). End
tags of rows and cells may be missing. A page without a table is a reject, a row
of the same parse (``outcomes``). Everything is a column expression: no Python
per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.sources import outcomes as O

NO_PAGE, NO_TABLE, NO_HEADER = "no page", "no table", "no header"

#: Comments, scripts and styles hold no markup of the page.
HIDDEN_RE = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
TABLE_TAG_RE = r"(?i)</?table\b[^>]*>"
ROW_RE = r"(?i)<tr\b[^>]*>"
CELL_RE = r"(?i)<t[hd]\b[^>]*>"
CELL_END_RE = r"(?is)</(?:t[hdr]|tbody|thead|tfoot)\b.*"
TAG_RE = r"(?s)<[^>]+>"

# Entities decoded in cell text (fixed list).
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")]


def _cell_text(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(c, CELL_END_RE, ""), TAG_RE, "")
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return F.nullif(F.trim(c), F.lit(""))


def first_table(tags: Column, pieces: Column) -> Column:
    """The inside of the first table, NULL if there is none; nested tables are reduced to their text.

    ``tags`` are a page's table tags, ``pieces`` what lies between them. Of the fold's state ``depth`` is the nesting
    after a tag, and ``done`` is set once the first table has ended. A table that is never closed ends with the
    page. End tags before the first table change nothing.
    """
    after = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    steps = F.zip_with(tags, after, lambda tag, text: F.struct(
        F.when(F.startswith(tag, F.lit("</")), -1).otherwise(1).alias("step"), text.alias("text")))
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("parts"))

    def fold(s: Column, x: Column) -> Column:
        depth = F.greatest(s["depth"] + x["step"], F.lit(0))
        own = F.when(depth == 1, x["text"]).otherwise(F.regexp_replace(F.regexp_replace(x["text"], TAG_RE, " "), r"\s+", " "))
        return F.when(s["done"], s).otherwise(F.struct(
            depth.alias("depth"), ((depth == 0) & (s["depth"] > 0)).alias("done"),
            F.when(depth > 0, F.array_append(s["parts"], own)).otherwise(s["parts"]).alias("parts")))

    return F.aggregate(steps, start, fold, lambda s: F.when(F.size(s["parts"]) > 0, F.array_join(s["parts"], "")))


def _cells(parts: Column) -> Column:
    """The cells' texts; ``parts`` is a row cut at the cells' start tags."""
    return F.transform(F.filter(parts, lambda _, i: i > 0), _cell_text)


def parse_tables(pages: DataFrame, keys: Sequence[str], html_col: str = "html",
                 rename: dict[str, str] | None = None) -> DataFrame:
    """Parse each page once: a row per data row of its first table, or one row for a page that has none.

    ``keys``, ``outcome``, ``row_no`` (1-based within the table; null without rows), ``header`` and ``cells``.
    """
    keys = list(keys)
    # every step is a column of its own: read more than once by the next, so computed once
    x = pages.select(*keys, F.regexp_replace(F.col(html_col), HIDDEN_RE, "").alias("_page"))
    x = x.select(*keys, "_page", F.regexp_extract_all("_page", F.lit(TABLE_TAG_RE), 0).alias("_tags"),
                 F.split("_page", TABLE_TAG_RE, -1).alias("_pieces"))
    x = x.select(*keys, F.col("_page").isNull().alias("_none"), first_table(F.col("_tags"), F.col("_pieces")).alias("_table"))
    x = x.select(*keys, "_none", "_table", F.split("_table", ROW_RE, -1).alias("_rows"))
    x = x.select(*keys, "_none", "_table", F.slice("_rows", 2, F.greatest(F.size("_rows") - 1, F.lit(0))).alias("_rows"))
    header = _cells(F.split(F.try_element_at("_rows", F.lit(1)), CELL_RE, -1))
    if rename:
        m = F.create_map(*[F.lit(v) for kv in rename.items() for v in kv])
        header = F.transform(header, lambda h: F.coalesce(m[h], h))
    outcome = (F.when(F.col("_none"), NO_PAGE).when(F.col("_table").isNull(), NO_TABLE)
               .when(F.size("_rows") == 0, NO_HEADER).when(F.size("_rows") == 1, O.EMPTY).otherwise(O.RECORD))
    body = F.when(F.size("_rows") > 1, F.slice("_rows", F.lit(2), F.size("_rows") - 1))
    # the header is read once for each table, before its rows are parted
    x = (x.select(*keys, outcome.alias("outcome"), header.alias("header"), body.alias("_body"))
         .select(*keys, "outcome", "header", F.posexplode_outer("_body").alias("_pos", "_row")))
    x = x.select(*keys, "outcome", "header", "_pos", _cells(F.split("_row", CELL_RE, -1)).alias("_cells"))
    # extra cells beyond the header are dropped, short rows pad with NULL
    padded = F.when(F.col("_cells").isNotNull(), F.transform(
        F.col("header"), lambda h, i: F.try_element_at(F.col("_cells"), i + 1)))
    return x.select(*keys, "outcome", (F.col("_pos") + 1).alias("row_no"), "header", padded.alias("cells"))


def first_of_page() -> Column:
    """Marks one row of each parsed page."""
    return F.coalesce(F.col("row_no"), F.lit(1)) == 1


def table_columns(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys``, ``row_no`` and the named columns of parsed rows.

    Cells are looked up by header position (a missing header gives NULL, a repeated one takes its first position),
    so duplicate or empty header names cannot fail the query.
    """
    pos = {c: F.array_position(F.col("header"), F.lit(c)) for c in columns}
    return rows.select(*keys, "row_no", *[
        F.when(pos[c] > 0, F.try_element_at(F.col("cells"), pos[c].cast("int"))).alias(c) for c in columns])


def first_table_rows(pages: DataFrame, keys: Sequence[str], html_col: str = "html",
                     rename: dict[str, str] | None = None,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """``(keys, html)`` -> one row per data row of the page's first table.

    Output: ``keys``, ``row_no`` (1-based within the table), then either the
    header names given in ``columns`` (after ``rename``) or the arrays ``header``
    and ``cells``. ``parse_tables`` has the rejects too.
    """
    rows = O.records(parse_tables(pages, keys, html_col, rename))
    return rows if columns is None else table_columns(rows, keys, columns)
