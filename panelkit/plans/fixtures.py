"""Source-shaped inputs derived from the driver's TPC-H-like tables.

The studied pipeline reads three scraped sources (events, polls, monthly
indicators). We derive the same shapes from whole driver tables, with no row
subsetting, so every query's work grows with the data:

* events      <- every ``lineitem`` row (ship date = publication date,
                 return flag = series key)
* polls       <- every ``orders`` row (order date -> poll dates in several
                 textual layouts; prices -> approval numbers, some junk)
* indicators  <- ``lineitem`` aggregated per ship month (text columns with
                 the ``'NA'`` sentinel in July, a leading gap, one raw NULL month)

Each Spark derivation has a DuckDB twin (``*_SQL``) used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.constants import SNAPSHOT_FLOOR  # noqa: F401  (re-exported for the query modules)

AS_OF = "2001-11-10"      # an explicit spine end; the registered queries end with the last event
RUN_TS = "2001-11-10 12:00:00"
SERIES = "series_key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    doc = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")
    return li.select(
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string")).otherwise(doc).alias("document_number"),
        F.col("l_linestatus").alias("person"),
        F.to_date("l_shipdate").alias("publication_date"),
        F.col("l_returnflag").alias(SERIES))


def fx_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    e = F.date_add(d, (F.col("o_orderkey") % 10).cast("int"))
    m, dd, y = (F.month(d).cast("string"), F.dayofmonth(d).cast("string"), F.year(d).cast("string"))
    k8 = F.col("o_orderkey") % 8
    s = F.lit("/")
    start = (F.when(k8 == 0, F.concat(m, s, dd, s, F.substring(y, 3, 2)))
             .when(k8 == 1, F.concat(m, s, dd, s, F.substring(y, 1, 1), s, F.substring(y, 2, 3)))
             .when(k8 == 2, F.lit(None).cast("string"))
             .when(k8 == 3, F.lit("unknown"))
             .when(k8 == 4, F.concat(F.lpad(m, 2, "0"), s, F.lpad(dd, 2, "0"), s, F.substring(y, 3, 2)))
             .otherwise(F.concat(m, s, dd, s, y)))
    end = F.when(F.col("o_orderkey") % 5 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.month(e).cast("string"), s, F.dayofmonth(e).cast("string"), s, F.year(e).cast("string")))
    price = F.floor("o_totalprice").cast("bigint")
    return o.select(
        F.col("o_orderkey").alias("poll_id"),
        start.alias("start_date"), end.alias("end_date"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("n/a")).otherwise((price % 100).cast("string")).alias("approving"),
        (price % 60).cast("string").alias("disapproving"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("")).otherwise((F.col("o_orderkey") % 10).cast("string")).alias("unsure_or_no_data"),
        F.col("o_orderpriority").alias("president"))


def fx_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    y, mo = F.col("y"), F.col("mo")

    def txt(c):
        return F.col(c).cast("bigint").cast("string")

    agg = (li.groupBy(F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("mo"))
           .agg(F.count(F.lit(1)).alias("BusinessApplications"),
                F.sum("l_linenumber").alias("s_line"),
                F.sum(F.col("l_partkey") % 97).alias("s_p97"),
                F.sum(F.col("l_suppkey") % 13).alias("s_s13"),
                F.sum(F.col("l_orderkey") % 11).alias("s_o11"),
                F.sum(F.col("l_orderkey") % 17).alias("s_o17"),
                F.sum(F.col("l_orderkey") % 19).alias("s_o19"),
                F.sum(F.col("l_partkey") % 23).alias("s_p23"),
                F.sum(F.col("l_partkey") % 29).alias("s_p29"),
                F.sum(F.col("l_partkey") % 31).alias("s_p31"),
                F.sum(F.col("l_suppkey") % 7).alias("s_s7"),
                F.sum(F.col("l_orderkey") % 37).alias("s_o37"),
                F.sum(F.col("l_orderkey") % 41).alias("s_o41"),
                F.sum(F.col("l_suppkey") % 5).alias("s_s5")))
    na = F.lit("NA")
    return agg.select(
        mo.cast("string").alias("Month"), y.cast("string").alias("Year"),
        F.col("BusinessApplications").cast("bigint").alias("BusinessApplications"),
        F.when(mo == 7, na).when((y == 1996) & (mo == 3), F.lit(None).cast("string"))
         .otherwise(txt("s_line")).alias("ConstructionSpending"),
        F.when((y == 1995) & (mo < 3), na).otherwise(txt("s_p97")).alias("DurableGoodsNewOrders"),
        txt("s_s13").alias("InternationalTrade_Exports"),
        txt("s_o11").alias("ManuInventories"),
        txt("s_o17").alias("ManuNewOrders"),
        txt("s_o19").alias("NewHomesForSale"),
        txt("s_p23").alias("NewHomesSold"),
        F.col("s_p29").cast("bigint").alias("ResConstPermits"),
        F.col("s_p31").cast("bigint").alias("ResConstUnitsCompleted"),
        F.col("s_s7").cast("bigint").alias("ResConstUnitsStarted"),
        txt("s_o37").alias("RetailInventories"),
        F.col("s_o41").cast("bigint").alias("SalesForRetailAndFood"),
        txt("s_s5").alias("WholesaleInventories"))


# ---------------------------------------------------------------- DuckDB twins

FX_EVENTS_SQL = """fx_events AS (
  SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) END AS document_number,
         l_linestatus AS person, CAST(l_shipdate AS DATE) AS publication_date, l_returnflag AS series_key
  FROM lineitem)"""

FX_POLLS_SQL = """fx_polls AS (
  SELECT o_orderkey AS poll_id,
         CASE o_orderkey % 8
           WHEN 0 THEN m || '/' || d || '/' || substr(y, 3, 2)
           WHEN 1 THEN m || '/' || d || '/' || substr(y, 1, 1) || '/' || substr(y, 2, 3)
           WHEN 2 THEN NULL
           WHEN 3 THEN 'unknown'
           WHEN 4 THEN lpad(m, 2, '0') || '/' || lpad(d, 2, '0') || '/' || substr(y, 3, 2)
           ELSE m || '/' || d || '/' || y END AS start_date,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL
              ELSE CAST(month(e) AS VARCHAR) || '/' || CAST(day(e) AS VARCHAR) || '/' || CAST(year(e) AS VARCHAR) END AS end_date,
         CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 100 AS VARCHAR) END AS approving,
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 60 AS VARCHAR) AS disapproving,
         CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_orderkey % 10 AS VARCHAR) END AS unsure_or_no_data,
         o_orderpriority AS president
  FROM (SELECT *, CAST(month(CAST(o_orderdate AS DATE)) AS VARCHAR) AS m,
               CAST(day(CAST(o_orderdate AS DATE)) AS VARCHAR) AS d,
               CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR) AS y,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) AS e
        FROM orders) t)"""

FX_INDICATORS_SQL = """fx_indicators AS (
  SELECT CAST(mo AS VARCHAR) AS Month, CAST(y AS VARCHAR) AS Year,
         CAST(n AS BIGINT) AS BusinessApplications,
         CASE WHEN mo = 7 THEN 'NA' WHEN y = 1996 AND mo = 3 THEN NULL
              ELSE CAST(CAST(s_line AS BIGINT) AS VARCHAR) END AS ConstructionSpending,
         CASE WHEN y = 1995 AND mo < 3 THEN 'NA' ELSE CAST(CAST(s_p97 AS BIGINT) AS VARCHAR) END AS DurableGoodsNewOrders,
         CAST(CAST(s_s13 AS BIGINT) AS VARCHAR) AS InternationalTrade_Exports,
         CAST(CAST(s_o11 AS BIGINT) AS VARCHAR) AS ManuInventories,
         CAST(CAST(s_o17 AS BIGINT) AS VARCHAR) AS ManuNewOrders,
         CAST(CAST(s_o19 AS BIGINT) AS VARCHAR) AS NewHomesForSale,
         CAST(CAST(s_p23 AS BIGINT) AS VARCHAR) AS NewHomesSold,
         CAST(s_p29 AS BIGINT) AS ResConstPermits,
         CAST(s_p31 AS BIGINT) AS ResConstUnitsCompleted,
         CAST(s_s7 AS BIGINT) AS ResConstUnitsStarted,
         CAST(CAST(s_o37 AS BIGINT) AS VARCHAR) AS RetailInventories,
         CAST(s_o41 AS BIGINT) AS SalesForRetailAndFood,
         CAST(CAST(s_s5 AS BIGINT) AS VARCHAR) AS WholesaleInventories
  FROM (SELECT year(l_shipdate) AS y, month(l_shipdate) AS mo, COUNT(*) AS n,
               SUM(l_linenumber) AS s_line, SUM(l_partkey % 97) AS s_p97, SUM(l_suppkey % 13) AS s_s13,
               SUM(l_orderkey % 11) AS s_o11, SUM(l_orderkey % 17) AS s_o17, SUM(l_orderkey % 19) AS s_o19,
               SUM(l_partkey % 23) AS s_p23, SUM(l_partkey % 29) AS s_p29, SUM(l_partkey % 31) AS s_p31,
               SUM(l_suppkey % 7) AS s_s7, SUM(l_orderkey % 37) AS s_o37, SUM(l_orderkey % 41) AS s_o41,
               SUM(l_suppkey % 5) AS s_s5
        FROM lineitem GROUP BY 1, 2) a)"""


def duck_poll_date(c: str, repair: bool = True) -> str:
    """DuckDB twin of ``parse_poll_date``."""
    t = f"trim({c})"
    plain = f"CAST(try_strptime({t}, '%m/%d/%y') AS DATE), CAST(try_strptime({t}, '%m/%d/%Y') AS DATE)"
    if not repair:
        return f"COALESCE({plain})"
    return (f"COALESCE({plain}, "
            f"CAST(try_strptime(regexp_replace({t}, '^([^/]*/[^/]*/[^/]*)/', '\\1'), '%m/%d/%Y') AS DATE))")


def duck_sunday(c: str) -> str:
    return f"(CAST({c} AS DATE) - CAST(dayofweek(CAST({c} AS DATE)) AS INTEGER))"


def polls_sort_sql(repair: bool = True) -> str:
    return f"""polls_sort AS (
  SELECT {duck_poll_date('start_date', repair)} AS period_start, {duck_poll_date('end_date', repair)} AS period_end,
         poll_id, approving, disapproving, unsure_or_no_data, president
  FROM fx_polls WHERE start_date IS NOT NULL OR end_date IS NOT NULL)"""


POLLS_SORT_SQL = polls_sort_sql()

INDICATORS_SORT_SQL = """indicators_sort AS (
  SELECT CAST(strptime(Month || '-' || Year, '%m-%Y') AS DATE) AS month_start, * EXCLUDE (Month, Year)
  FROM fx_indicators)"""

EVENTS_SORT_SQL = """events_sort AS (
  SELECT series_key, publication_date, COUNT(*) AS events_on_date FROM fx_events GROUP BY series_key, publication_date)"""

SPINE_SQL = f"""anchors AS (
  SELECT series_key, {duck_sunday('min(publication_date)')} AS first_week FROM events_sort GROUP BY series_key),
week_array AS (
  SELECT series_key, CAST(unnest(generate_series(CAST(first_week AS TIMESTAMP),
    CAST((SELECT max(publication_date) FROM events_sort) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS week_start
  FROM anchors)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------- snapshots
# (dt, days by which the snapshot restates the publication dates). The oldest is
# below the floor; the newest restates every event, so picking the wrong
# snapshot changes the answer.
SNAPSHOTS = [("2025-01-18", 0), ("2025-02-01", 0), ("2025-02-08", 7)]


def fx_event_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event in every snapshot (3 copies), its date as the snapshot states it."""
    import datetime as dt
    ev = fx_events(spark, sf_dir)
    arr = F.array(*[F.struct(F.lit(dt.date.fromisoformat(d)).alias("dt"), F.lit(n).alias("days")) for d, n in SNAPSHOTS])
    return (ev.withColumn("_s", F.explode(arr))
            .select("document_number", "person", F.date_add("publication_date", F.col("_s.days")).alias("publication_date"),
                    SERIES, F.col("_s.dt").alias("dt"), F.lit("en").alias("lang")))


SNAPSHOTS_SQL = "snaps AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT * REPLACE (publication_date + {n} AS publication_date), DATE '{d}' AS dt, 'en' AS lang FROM fx_events"
    for d, n in SNAPSHOTS) + ")"

# ---------------------------------------------------------- scraped pages
POLL_HEADER = ["Start Date", "End Date", "Approving", "Disapproving", "Unsure/No Data", "Notes"]
POLL_RENAME = {"Start Date": "start_date", "End Date": "end_date", "Approving": "approving",
               "Disapproving": "disapproving", "Unsure/No Data": "unsure_or_no_data", "Notes": "notes"}
NOTES_EVERY = 16  # every so many poll ids the notes cell holds a table of its own
PAGE_ROWS = 512   # poll rows per generated page (bounded page size)


def fx_poll_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls rendered as HTML pages: one page per (president, block of poll ids).

    Each page holds a header row, at most ``PAGE_ROWS`` data rows (some with a
    table inside a cell) and a second (decoy) table; raw web pages from
    ``pages`` (no tables) are added too.
    """
    polls = fx_polls(spark, sf_dir)
    vals = ["start_date", "end_date", "approving", "disapproving", "unsure_or_no_data"]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), F.coalesce(F.col(c), F.lit("")), F.lit("</td>"))
                                    for c in vals],
                   F.when(F.col("poll_id") % NOTES_EVERY == 0, F.lit(
                       "<td>see<table><tr><td>a</td></tr><tr><td>b</td></tr></table></td>")).otherwise(F.lit("<td></td>")),
                   F.lit("</tr>"))
    head = "<tr>" + "".join(f"<th>{h}</th>" for h in POLL_HEADER) + "</tr>"
    grouped = (polls.select("president", F.floor(F.col("poll_id") / PAGE_ROWS).alias("page_no"),
                            "poll_id", row.alias("tr"))
               .groupBy("president", "page_no")
               .agg(F.array_sort(F.collect_list(F.struct("poll_id", "tr"))).alias("_rows")))
    html = F.concat(F.lit("<html><body><h1>Approval</h1><table class='ratings'>" + head),
                    F.array_join(F.col("_rows.tr"), ""),
                    F.lit("</table><p>Notes</p><table><tr><th>Note</th></tr><tr><td>decoy</td></tr></table>"
                          "</body></html>"))
    tables = grouped.select("president", "page_no", html.alias("html"))
    raw = table(spark, sf_dir, "pages").select(F.col("url").alias("president"),
                                               F.lit(-1).cast("long").alias("page_no"), "html")
    return tables.unionByName(raw)


# ------------------------------------------------------------- API pages
API_BLOCK = 64   # order keys per page (<= 7 lines each)


def fx_api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON envelopes ``{"count", "results": [...], "next_page_url"}``."""
    li = table(spark, sf_dir, "lineitem")
    ev = li.select(F.floor(F.col("l_orderkey") / API_BLOCK).alias("page"),
                   F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
                    .otherwise((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")).alias("document_number"),
                   F.col("l_linestatus").alias("person"),
                   F.to_date("l_shipdate").alias("publication_date"),
                   F.col("l_returnflag").alias(SERIES))
    recs = F.collect_list(F.struct("document_number", "person", "publication_date", SERIES))
    env = F.struct(F.count(F.lit(1)).cast("string").alias("count"), recs.alias("results"),
                   F.concat(F.lit("page="), (F.col("page") + 1).cast("string")).alias("next_page_url"))
    return ev.groupBy("page").agg(F.to_json(env).alias("body"))


def fx_api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All API pages, and what else an endpoint may answer, from every row of ``pages``: its HTML, an envelope that
    names an error, or nothing at all."""
    k3 = F.col("page_id") % 3
    other = F.when(k3 == 0, F.col("html")).when(k3 == 1, F.to_json(F.struct(F.col("url").alias("error"))))
    good = fx_api_pages(spark, sf_dir).select(F.col("page").cast("string").alias("page"), "body")
    return good.unionByName(table(spark, sf_dir, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("page"), other.alias("body")))
