"""Phase 2 queries: snapshots, runs, picks, manifests, scraped tables, API pages, I/O."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from panelkit.operators import panel as P
from panelkit.plans import fixtures as FX
from panelkit.plans.fixtures import (EVENTS_SORT_SQL, FX_EVENTS_SQL, FX_POLLS_SQL, SERIES,
                                     SNAPSHOT_FLOOR, SNAPSHOTS_SQL, with_ctes)
from panelkit.plans.q_panel import events_sorted, panel, panel_sql
from panelkit.plans.registry import register, round_doubles
from panelkit.session import work_dir
from panelkit.sources import snapshots as S
from panelkit.sources import api_pages as A
from panelkit.sources import html as H
from panelkit.sources.api_pages import flatten_pages
from panelkit.sources.html import first_table_rows
from panelkit.sources.outcomes import land_parsed

EVENT_RECORD = StructType([StructField("document_number", StringType()),
                           StructField("person", StringType()),
                           StructField("publication_date", DateType()),
                           StructField(SERIES, StringType())])

LATEST_SQL = with_ctes(FX_EVENTS_SQL, SNAPSHOTS_SQL) + f"""SELECT series_key, publication_date, COUNT(*) AS events_on_date
FROM snaps WHERE dt = (SELECT max(dt) FROM snaps WHERE dt > DATE '{SNAPSHOT_FLOOR}')
GROUP BY series_key, publication_date"""


@register("latest_snapshot", LATEST_SQL, covers="S8 A5 F1 D8 D9")
def q_latest_snapshot(spark, sf):
    snaps = FX.fx_event_snapshots(spark, sf)
    return P.events_by_date(S.latest_snapshot(snaps, SNAPSHOT_FLOOR), keys=[SERIES])


@register("partitioned_roundtrip", LATEST_SQL, covers="S2 S3 S8 D8")
def q_partitioned_roundtrip(spark, sf):
    """Land the snapshots as NDJSON under dt=/lang=, read back with an explicit
    schema; the newest-snapshot filter prunes to one partition."""
    root = work_dir(spark, "events_raw")
    S.land(FX.fx_event_snapshots(spark, sf), root, fmt="json")
    newest = S.read_latest_snapshot(spark, root, EVENT_RECORD, fmt="json", floor=SNAPSHOT_FLOOR)
    return P.events_by_date(newest, keys=[SERIES])


RUNS = ["2001-11-03 09:00:00", "2001-11-10 06:00:00", FX.RUN_TS]


@register("latest_run", panel_sql(), covers="S9 S10 S11 S12 F8 P1")
def q_latest_run(spark, sf):
    """Append three runs of the panel (create-if-absent, partitioned by run day)
    and read back only the newest run (two of them share its day)."""
    base = work_dir(spark, "panel_once")
    S.overwrite_table(panel(spark, sf), base)
    stored = spark.read.parquet(base)
    path = work_dir(spark, "weekly_panel_runs")
    expected = StructType.fromDDL(f"{SERIES} STRING, " + P.PANEL_SCHEMA_DDL)
    for ts in RUNS:
        S.append_run(stored.withColumn("run_date", F.lit(ts).cast("timestamp_ntz")), path, expected)
    return round_doubles(S.read_latest_run(spark, path))


SNAPSHOT_PICK_SQL = """WITH avail AS (SELECT DISTINCT l_returnflag AS source, CAST(l_shipdate AS DATE) AS snapshot_date FROM lineitem),
fridays AS (SELECT DISTINCT source,
                   snapshot_date + CAST(((4 - (CAST(dayofweek(snapshot_date) AS INTEGER) + 6) % 7) + 7) % 7 AS INTEGER) AS friday
            FROM avail)
SELECT f.source, f.friday, max(a.snapshot_date) AS picked_date, COUNT(*) AS n_candidates
FROM fridays f JOIN avail a ON a.source = f.source AND a.snapshot_date BETWEEN f.friday - 5 AND f.friday
GROUP BY f.source, f.friday"""


@register("snapshot_pick", SNAPSHOT_PICK_SQL, covers="S5 D11")
def q_snapshot_pick(spark, sf):
    li = FX.table(spark, sf, "lineitem")
    avail = li.select(F.col("l_returnflag").alias("source"),
                      F.to_date("l_shipdate").alias("snapshot_date")).distinct()
    return S.snapshot_pick(avail, lookback_days=5)


MANIFEST_SQL = with_ctes(FX_EVENTS_SQL, SNAPSHOTS_SQL) + """SELECT dt, COUNT(*) AS n_records,
  max(TRY_CAST(document_number AS BIGINT)) AS max_number,
  count(*) FILTER (WHERE document_number IS NOT NULL AND TRY_CAST(document_number AS BIGINT) IS NULL) AS n_bad_numbers,
  count(*) FILTER (WHERE document_number IS NULL) AS n_null_numbers,
  max(publication_date) AS max_date,
  concat_ws('_', CAST(COUNT(*) AS VARCHAR), CAST(max(TRY_CAST(document_number AS BIGINT)) AS VARCHAR),
            strftime(max(publication_date), '%Y%m%d')) AS label
FROM snaps GROUP BY dt"""


@register("manifest", MANIFEST_SQL, covers="S15 A13 F5 A15 C5 D10")
def q_manifest(spark, sf):
    return S.manifest(FX.fx_event_snapshots(spark, sf), keys=["dt"])


POLL_MANIFEST_SQL = with_ctes(FX_POLLS_SQL) + r"""SELECT president,
  max_by(start_date, try_strptime(start_date, '%m/%d/%Y'))
    FILTER (WHERE regexp_matches(start_date, '^\d{1,2}/\d{1,2}/\d{4}') AND try_strptime(start_date, '%m/%d/%Y') IS NOT NULL) AS latest_raw,
  count(*) FILTER (WHERE regexp_matches(start_date, '^\d{1,2}/\d{1,2}/\d{4}')) AS n_well_formed,
  count(*) FILTER (WHERE regexp_matches(start_date, '^\d{1,2}/\d{1,2}/\d{4}') AND try_strptime(start_date, '%m/%d/%Y') IS NULL) AS n_unparsable,
  replace(max_by(start_date, try_strptime(start_date, '%m/%d/%Y'))
    FILTER (WHERE regexp_matches(start_date, '^\d{1,2}/\d{1,2}/\d{4}') AND try_strptime(start_date, '%m/%d/%Y') IS NOT NULL), '/', '-') AS latest_label
FROM fx_polls GROUP BY president"""


@register("poll_manifest", POLL_MANIFEST_SQL, covers="A12 F4 X3 D10")
def q_poll_manifest(spark, sf):
    return S.latest_raw_date(FX.fx_polls(spark, sf), "start_date", keys=["president"])


HTML_SQL = with_ctes(FX_POLLS_SQL) + """SELECT president, NULLIF(start_date, '') AS start_date, NULLIF(end_date, '') AS end_date,
  NULLIF(approving, '') AS approving, NULLIF(disapproving, '') AS disapproving,
  NULLIF(unsure_or_no_data, '') AS unsure_or_no_data,
  CASE WHEN poll_id % {every} = 0 THEN 'see a b' END AS notes
FROM fx_polls""".replace("{every}", str(FX.NOTES_EVERY))


@register("html_table_rows", HTML_SQL, covers="S6 P5")
def q_html_table_rows(spark, sf):
    pages = FX.fx_poll_pages(spark, sf)
    cols = list(FX.POLL_RENAME.values())
    rows = first_table_rows(pages, ["president", "page_no"], rename=FX.POLL_RENAME, columns=cols)
    return rows.select("president", *cols)


UNION_SQL = with_ctes(FX_POLLS_SQL) + """SELECT poll_id, start_date, end_date, approving, disapproving,
  CASE WHEN president IN ('1-URGENT', '2-HIGH') THEN NULL ELSE unsure_or_no_data END AS unsure_or_no_data, president
FROM fx_polls"""


@register("union_by_name", UNION_SQL, covers="U1")
def q_union_by_name(spark, sf):
    polls = FX.fx_polls(spark, sf)
    old = ["1-URGENT", "2-HIGH"]
    a = polls.where(F.col("president").isin(old)).drop("unsure_or_no_data")
    b = polls.where(~F.col("president").isin(old)).select(*reversed(polls.columns))
    return a.unionByName(b, allowMissingColumns=True)


#: Of each kind of page: how many rows of the fixture's table it has, its rejects with their reasons.
REJECTS_SQL = """rejected AS (
  SELECT 'api' AS source, 'p' || CAST(page_id AS VARCHAR) AS page,
         CASE page_id % 3 WHEN 0 THEN 'no JSON' WHEN 1 THEN 'no results array' ELSE 'no body' END AS reason FROM pages
  UNION ALL SELECT 'polls', url || '#-1', 'no table' FROM pages)"""


def landed_pages(spark, sf):
    """Both kinds of pages, each parsed and written once: records, rejects and counts of the same pass."""
    api = A.parse_pages(FX.fx_api_responses(spark, sf), "body", EVENT_RECORD, ("page",))
    key = F.concat("president", F.lit("#"), F.col("page_no").cast("string")).alias("page")
    polls = H.parse_tables(FX.fx_poll_pages(spark, sf).select(key, "html"), ["page"], rename=FX.POLL_RENAME)
    return {"api": land_parsed(api, work_dir(spark, "api_parsed"), A.first_of_page()),
            "polls": land_parsed(polls, work_dir(spark, "polls_parsed"), H.first_of_page())}


@register("page_rejects", with_ctes(REJECTS_SQL) + "SELECT source, page, reason FROM rejected", covers="S1 S6 (rejects)")
def q_page_rejects(spark, sf):
    parts = [landed.rejects(spark, ["page"]).select(F.lit(name).alias("source"), "page", "reason")
             for name, landed in landed_pages(spark, sf).items()]
    return parts[0].unionByName(parts[1])


@register("page_manifest", with_ctes(REJECTS_SQL) + f"""SELECT 'api' AS source,
  (SELECT count(DISTINCT l_orderkey // {FX.API_BLOCK}) FROM lineitem) + count(*) AS n_pages,
  (SELECT count(*) FROM lineitem) AS n_records, 0::BIGINT AS n_empty, count(*) AS n_rejected
FROM rejected WHERE source = 'api'
UNION ALL
SELECT 'polls', (SELECT count(DISTINCT (o_orderpriority, o_orderkey // {FX.PAGE_ROWS})) FROM orders) + count(*),
  (SELECT count(*) FROM orders), 0, count(*)
FROM rejected WHERE source = 'polls'""", covers="S1 S6 S15 (page counts)")
def q_page_manifest(spark, sf):
    """Pages, records, empty pages and rejects of each kind of page, counted while the parse was written."""
    rows = [(name, p.n_pages, p.n_records, p.n_empty, p.n_rejected) for name, p in landed_pages(spark, sf).items()]
    return spark.createDataFrame(rows, "source string, n_pages long, n_records long, n_empty long, n_rejected long")


API_SQL = with_ctes(FX_EVENTS_SQL) + "SELECT document_number, person, publication_date, series_key FROM fx_events"


@register("api_pages_flatten", API_SQL, covers="S1 U2 X4 X5")
def q_api_pages_flatten(spark, sf):
    return flatten_pages(FX.fx_api_pages(spark, sf), "body", EVENT_RECORD).drop("is_last_page")


@register("events_desc", with_ctes(FX_EVENTS_SQL, EVENTS_SORT_SQL)
          + "SELECT * FROM events_sort ORDER BY publication_date DESC", covers="O1")
def q_events_desc(spark, sf):
    return events_sorted(spark, sf).orderBy(F.col("publication_date").desc())


@register("panel_head", panel_sql() + "\nORDER BY w.week_start, w.series_key LIMIT 5",
          covers="O4 O2 O3")
def q_panel_head(spark, sf):
    return round_doubles(panel(spark, sf).drop("run_date").orderBy("week_start", SERIES).limit(5))



@register("ingest_available_now", LATEST_SQL, covers="S16 §2.12")
def q_ingest_available_now(spark, sf):
    """Land two snapshots, ingest incrementally; land a late older snapshot,
    ingest again (and once more with nothing new): the curated table is the
    newest snapshot's per-date counts throughout."""
    from panelkit.streaming.ingest import ingest_available_now, read_curated
    base = work_dir(spark, "stream")
    landing, mirror, curated = f"{base}/landing", f"{base}/mirror", f"{base}/curated"
    man, ckpt = f"{base}/manifest", f"{base}/_checkpoint"
    snaps = FX.fx_event_snapshots(spark, sf)
    curate = lambda df: P.events_by_date(df, keys=[SERIES])
    S.land(snaps.where(F.col("dt") != F.lit("2025-02-01").cast("date")), landing, fmt="json")
    ingest_available_now(spark, landing, EVENT_RECORD, mirror, curated, man, ckpt, curate, SNAPSHOT_FLOOR)
    S.land(snaps.where(F.col("dt") == F.lit("2025-02-01").cast("date")), landing, fmt="json")
    ingest_available_now(spark, landing, EVENT_RECORD, mirror, curated, man, ckpt, curate, SNAPSHOT_FLOOR)
    ingest_available_now(spark, landing, EVENT_RECORD, mirror, curated, man, ckpt, curate, SNAPSHOT_FLOOR)
    return read_curated(spark, curated)


@register("ingest_manifest", MANIFEST_SQL, covers="S15 S16 A13")
def q_ingest_manifest(spark, sf):
    """Every snapshot lands in two parts, ingested one after the other: the manifest is merged from the batches'
    parts and equals that of the whole."""
    from panelkit.streaming.ingest import ingest_available_now, read_manifest
    base = work_dir(spark, "stream_manifest")
    snaps = FX.fx_event_snapshots(spark, sf)
    late = F.month("publication_date") > 6
    for part in (snaps.where(~late), snaps.where(late)):
        S.land(part, f"{base}/landing", fmt="json")
        ingest_available_now(spark, f"{base}/landing", EVENT_RECORD, f"{base}/mirror", f"{base}/curated", f"{base}/manifest",
                             f"{base}/_checkpoint", lambda df: P.events_by_date(df, keys=[SERIES]), SNAPSHOT_FLOOR)
    return read_manifest(spark, f"{base}/manifest")


POLL_RAW = StructType([StructField(c, StringType()) for c in
                       ["poll_id", "start_date", "end_date", "approving", "disapproving", "unsure_or_no_data",
                        "president"]])


@register("csv_snapshot_roundtrip", with_ctes(FX_POLLS_SQL) + """SELECT CAST(poll_id AS VARCHAR) AS poll_id,
  NULLIF(start_date, '') AS start_date, NULLIF(end_date, '') AS end_date, NULLIF(approving, '') AS approving,
  NULLIF(disapproving, '') AS disapproving, NULLIF(unsure_or_no_data, '') AS unsure_or_no_data,
  NULLIF(president, '') AS president FROM fx_polls""",
          covers="S4 S7 S3 S8")
def q_csv_snapshot_roundtrip(spark, sf):
    """Land the polls as a CSV snapshot with header under dt=/lang=, plus an older
    snapshot, and read the newest back with an explicit all-text schema."""
    root = work_dir(spark, "polls_raw")
    polls = FX.fx_polls(spark, sf).select(*[F.col(c).cast("string") for c in POLL_RAW.fieldNames()])
    S.land(polls.select("*", F.lit("2025-01-18").cast("date").alias("dt"), F.lit("en").alias("lang")), root, fmt="csv")
    S.land(polls.select("*", F.lit("2025-02-08").cast("date").alias("dt"), F.lit("en").alias("lang")), root, fmt="csv")
    # an empty CSV field reads back as NULL; the raw '' sentinel is therefore NULL here
    return S.read_latest_snapshot(spark, root, POLL_RAW, "csv", SNAPSHOT_FLOOR).drop("dt", "lang")


@register("panel_csv_extract", panel_sql(), covers="S14 D12 O3")
def q_panel_csv_extract(spark, sf):
    """Write the panel as a CSV extract with header, read it back with the fixed
    panel schema, parse dates and sort by week (the exploration notebook's input)."""
    path = work_dir(spark, "panel_extract")
    panel(spark, sf).drop("run_date").write.mode("overwrite").option("header", True).csv(path)
    schema = StructType.fromDDL(f"{SERIES} STRING, " + P.PANEL_SCHEMA_DDL.replace(", run_date TIMESTAMP_NTZ", ""))
    back = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("dateFormat", "yyyy-MM-dd").csv(path))
    return round_doubles(back.orderBy(SERIES, "week_start"))



INGEST_SOURCES_SQL = with_ctes(FX_EVENTS_SQL, SNAPSHOTS_SQL, FX_POLLS_SQL, FX.POLLS_SORT_SQL, FX.FX_INDICATORS_SQL,
                               FX.INDICATORS_SORT_SQL) + f"""SELECT 'events' AS source, publication_date AS day, COUNT(*) AS n_records
FROM snaps WHERE dt = (SELECT max(dt) FROM snaps WHERE dt > DATE '{SNAPSHOT_FLOOR}') GROUP BY ALL
UNION ALL SELECT 'polls', period_start, COUNT(*) FROM polls_sort GROUP BY ALL
UNION ALL SELECT 'indicators', month_start, COUNT(*) FROM indicators_sort GROUP BY ALL"""


@register("ingest_sources", INGEST_SOURCES_SQL, covers="S16 §2.12")
def q_ingest_sources(spark, sf):
    """One trigger for the three sources in order (event JSON, poll CSV, indicator CSV), each landed with an
    older snapshot too; a second trigger finds nothing new. Curated records by source and day."""
    from panelkit.streaming.ingest import Source, ingest_sources, read_curated
    base = work_dir(spark, "sources")
    text = lambda df: df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    polls = text(FX.fx_polls(spark, sf).select(*POLL_RAW.fieldNames()))
    indicators = text(FX.fx_indicators(spark, sf))
    S.land(FX.fx_event_snapshots(spark, sf), f"{base}/landing/events")
    for name, df in (("polls", polls), ("indicators", indicators)):
        days = F.explode(F.array(*[F.lit(d).cast("date") for d in ("2025-01-18", "2025-02-08")])).alias("dt")
        S.land(df.select("*", days, F.lit("en").alias("lang")), f"{base}/landing/{name}", fmt="csv")
    sources = [Source("events", EVENT_RECORD, lambda df: P.events_by_date(df, keys=[SERIES])),
               Source("polls", POLL_RAW, P.curate_polls, "csv"),
               Source("indicators", indicators.schema, P.curate_indicators, "csv")]
    for _ in range(2):
        paths = ingest_sources(spark, sources, f"{base}/landing", f"{base}/out")
    day = {"events": ("publication_date", F.sum("events_on_date")), "polls": ("period_start", F.count(F.lit(1))),
           "indicators": ("month_start", F.count(F.lit(1)))}
    parts = [read_curated(spark, paths[name]).groupBy(F.col(c).alias("day"))
             .agg(n.cast("bigint").alias("n_records")).select(F.lit(name).alias("source"), "day", "n_records")
             for name, (c, n) in day.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
