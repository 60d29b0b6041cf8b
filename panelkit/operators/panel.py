"""Weekly panel: date spine, calendar-bucket joins, and the composite panel.

Scale notes
-----------
* Raw events are reduced to one row per ``(keys, week)`` with a partial
  (map-side) aggregate before anything is joined, so a hot key or a hot day
  never reaches a join as raw rows.
* Polls are reduced to one row per month (``avg`` per value, ``count(*)``)
  before the join. The studied SQL joins raw polls to raw event dates and only
  then groups, which multiplies rows by k dates x m polls per week; we compute
  the same numbers at grain (see ``fanout``).
* All joins are equi-joins on ``(keys, week_start)`` or ``month``; none is a
  nested-loop or cartesian join. We add no broadcast hints: the month-level
  tables are bounded by the calendar, and AQE turns a join into a broadcast
  only after measuring the side at runtime (``autoBroadcastJoinThreshold``);
  beyond the threshold it stays a shuffle join.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.cleaning import na_to_null, safe_double
from panelkit.functions.dates import (month_start, parse_month_year,
                                      parse_poll_date, sunday_week)

# Fixed column contract of the weekly panel (20 columns, in order).
POLL_VALUES = ["approving", "disapproving", "unsure_or_no_data"]
INDICATORS = [
    "BusinessApplications", "ConstructionSpending", "DurableGoodsNewOrders",
    "InternationalTrade_Exports", "ManuInventories", "ManuNewOrders",
    "NewHomesForSale", "NewHomesSold", "ResConstPermits",
    "ResConstUnitsCompleted", "ResConstUnitsStarted", "RetailInventories",
    "SalesForRetailAndFood", "WholesaleInventories",
]
# Indicators that arrive as text holding a number or the 'NA' sentinel.
INDICATORS_NA = [
    "ConstructionSpending", "DurableGoodsNewOrders", "InternationalTrade_Exports",
    "ManuInventories", "ManuNewOrders", "NewHomesForSale", "NewHomesSold",
    "RetailInventories", "WholesaleInventories",
]
PRESENCE_COLUMN = "ConstructionSpending"
OUTCOME = "orders_outcome_var"
PANEL_COLUMNS = ["week_start", *POLL_VALUES, *INDICATORS, OUTCOME, "run_date"]
EXOGENOUS = [*POLL_VALUES, *INDICATORS]


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


# --------------------------------------------------------------------------
# Curated (cleaned) source tables
# --------------------------------------------------------------------------

def events_by_date(events: DataFrame, date_col: str = "publication_date",
                   keys: Sequence[str] = ()) -> DataFrame:
    """Events of each day (a NULL date is its own group)."""
    return (events.groupBy(*keys, F.col(date_col).alias("publication_date"))
            .agg(F.count(F.lit(1)).alias("events_on_date")))


def curate_polls(polls: DataFrame, repair: bool = True) -> DataFrame:
    """Parse both poll dates; keep rows where either raw date is present.

    Rows whose dates fail to parse are kept with NULL period dates; they are
    part of the curated table but never match a panel month.
    """
    rest = [c for c in polls.columns if c not in ("start_date", "end_date", "dt", "lang")]
    return (polls
            .where(F.col("start_date").isNotNull() | F.col("end_date").isNotNull())
            .select(parse_poll_date("start_date", repair).alias("period_start"),
                    parse_poll_date("end_date", repair).alias("period_end"),
                    *rest))


def curate_indicators(indicators: DataFrame) -> DataFrame:
    """The indicators with the first day of their month in place of the month and year texts."""
    rest = [c for c in indicators.columns if c not in ("Month", "Year", "dt", "lang")]
    return indicators.select(parse_month_year("Month", "Year").alias("month_start"), *rest)


# --------------------------------------------------------------------------
# Spine and bucket joins
# --------------------------------------------------------------------------

def week_counts(events: DataFrame, date_col: str = "publication_date",
                keys: Sequence[str] = (), count_col: str | None = None) -> DataFrame:
    """Events per ``(keys, Sunday week)``; one shuffle, partial aggregation.

    ``count_col`` sums an existing per-date count (e.g. the curated
    ``events_on_date``) instead of counting rows.
    """
    d = F.col(date_col)
    measure = F.sum(count_col) if count_col else F.count(F.lit(1))
    return (events.where(d.isNotNull())
            .groupBy(*keys, sunday_week(d).alias("week_start"))
            .agg(measure.cast("bigint").alias("n_events")))


def week_anchor(weekly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sunday of the first event week per key.

    Takes the already-aggregated weekly counts: the minimum week equals the
    week of the minimum date, and the input is tiny.
    """
    return weekly.groupBy(*keys).agg(F.min("week_start").alias("first_week"))


def date_spine(anchors: DataFrame, as_of, keys: Sequence[str] = (),
               step_days: int = 7, start_col: str = "first_week") -> DataFrame:
    """Every seventh day per key, from its first week to ``as_of``.

    Each key row emits its own weeks (``explode``), so the spine is built in
    parallel and never through a cartesian product.
    """
    start = F.col(start_col)
    end = _lit_date(as_of)
    seq = F.sequence(start, end, F.expr(f"INTERVAL {int(step_days)} DAYS"))
    weeks = F.when(start <= end, seq).otherwise(F.array().cast("array<date>"))
    return anchors.select(*keys, F.explode(weeks).alias("week_start"))


def last_week(weekly: DataFrame, value_cols: Sequence[str] = ("n_events",)) -> Column:
    """The last week of any key, as a scalar subquery on the weekly counts.

    It takes the whole row's maximum, so that it plans the same aggregate (and
    shares its shuffle) as the query around it.
    """
    rows = weekly.where(F.col("week_start").isNotNull())
    return rows.select(F.max(F.struct("week_start", *value_cols))).scalar().getField("week_start")


def fill_weeks(weekly: DataFrame, as_of, keys: Sequence[str] = (),
               value_cols: Sequence[str] = ("n_events",)) -> DataFrame:
    """Spine + left join in one pass: every week from the key's first week to ``as_of`` (None: the last week of any key).

    Equivalent to ``date_spine(week_anchor(weekly)) LEFT JOIN weekly``, but
    without a self-join: each weekly row emits itself followed by the empty
    weeks up to the next observed week (``lead``), with NULL values. The raw
    events are therefore aggregated and scanned once. The window is
    partitioned by the series keys and holds at most one row per week.
    """
    if as_of is None:  # the filter of ``last_week`` here too: equal plans share one shuffle of the weekly counts
        weekly = weekly.where(F.col("week_start").isNotNull())
    end = last_week(weekly, value_cols) if as_of is None else _lit_date(as_of)
    w = Window.partitionBy(*keys).orderBy("week_start")
    stop = F.coalesce(F.date_sub(F.col("_next"), 7), end)
    seq = F.sequence(F.col("week_start"), stop, F.expr("INTERVAL 7 DAYS"))
    if as_of is not None:
        weekly = weekly.where(F.col("week_start") <= end)
    x = (weekly.withColumn("_next", F.lead("week_start").over(w))
         .select(*keys, *value_cols, F.posexplode(seq).alias("_pos", "_wk")))
    return x.select(*keys, F.col("_wk").alias("week_start"),
                    *[F.when(F.col("_pos") == 0, F.col(c)).alias(c) for c in value_cols])


def spine_join(weekly: DataFrame, as_of, value_cols: Sequence[str] = ("n_events",)) -> DataFrame:
    """One-series form of ``fill_weeks`` without any window: a global anchor,
    its spine (``explode``) and an equi-join on ``week_start``.

    The anchor is ``min(struct(week_start, n_events))`` rather than
    ``min(week_start)`` so it must read the weekly aggregate (Catalyst would
    otherwise drop that aggregate and re-scan raw events); the weekly shuffle
    is then shared by both branches.
    """
    # the join would infer and push ``week_start IS NOT NULL`` into one branch
    # only; stating it on the shared input keeps both branches identical
    weekly = weekly.where(F.col("week_start").isNotNull())
    row = F.struct("week_start", *value_cols)
    ends = weekly.agg(F.min(row).alias("_a"), F.max(row).alias("_z")).select(
        F.col("_a.week_start").alias("first_week"), F.col("_z.week_start").alias("last_week"))
    spine = date_spine(ends, F.col("last_week") if as_of is None else as_of)
    return spine.join(weekly.select("week_start", *value_cols), "week_start", "left")


def week_range_join(spine: DataFrame, points: DataFrame, point_col: str,
                    keys: Sequence[str] = (), how: str = "left") -> DataFrame:
    """Points joined to the week that holds them, as an equi-join.

    Sunday weeks tile the calendar without overlap, so the range predicate is
    equivalent to ``sunday_week(point) = week_start``: a hash join instead of
    the nested-loop join the range predicate would plan as.
    """
    p = points.withColumn("week_start", sunday_week(point_col))
    return spine.join(p, [*keys, "week_start"], how)


#: A bucket of more points than this is split, and so is none that holds less than this share of all points.
POINTS_PER_PART = 1_000_000
LEAST_SHARE = 10_000


def bucket_parts(points: DataFrame, on: Sequence[str], points_per_part: int = POINTS_PER_PART) -> DataFrame:
    """``on`` and ``_parts`` of the buckets that need splitting, from the count of their points.

    A split bucket has over a 10,000th (``LEAST_SHARE``) of all points, so there are fewer than 10,000 of them,
    however large the table; that bound makes it safe to broadcast the result.
    """
    counts = points.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    most = F.greatest(F.lit(points_per_part), F.ceil(counts.select(F.sum("_n")).scalar() / LEAST_SHARE))
    return counts.where(F.col("_n") > most).select(*on, F.ceil(F.col("_n") / most).cast("int").alias("_parts"))


def bucketed_range_join(points: DataFrame, point_col: str, intervals: DataFrame,
                        lo_col: str, hi_col: str, bucket_days: int = 7,
                        keys: Sequence[str] = (), how: str = "inner",
                        points_per_part: int = POINTS_PER_PART) -> DataFrame:
    """General ``lo <= point <= hi`` join for overlapping intervals.

    Each interval is exploded to the fixed-width day buckets it covers, each
    point gets its single bucket; equi-join on ``(keys, bucket)`` then re-check
    the exact bounds. A matching pair meets in exactly one bucket (the
    point's), so no de-duplication is needed and no pair is dropped: long
    intervals simply emit more bucket rows. Choose ``bucket_days`` near the
    usual interval length. Intervals with a NULL bound match nothing.
    ``how='left'`` keeps each interval without points once.

    A bucket with many points is many tasks' work: its points are counted
    first, dealt by their hash to parts of about ``points_per_part``, and its
    intervals go to each part. Other buckets, and so most intervals, are not
    copied. Equal points share a part; give them as one row with a count. A
    bucket with many intervals is split by Spark's skew join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    w = int(bucket_days)
    on = [*keys, "_bucket"]
    epoch = F.lit(_dt.date(1970, 1, 1))

    def bucket(c):
        return F.floor(F.datediff(c, epoch) / w).cast("long")

    lo, hi = F.col(lo_col), F.col(hi_col)
    meets = lo.isNotNull() & hi.isNotNull() & (lo <= hi)
    pt = points.where(F.col(point_col).isNotNull()).withColumn("_bucket", bucket(F.col(point_col)))
    parts = F.broadcast(bucket_parts(pt, on, points_per_part))
    hashed = [f.name for f in points.schema.fields
              if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    n = F.coalesce("_parts", F.lit(1))
    pt = pt.join(parts, on, "left").withColumn("_part", F.pmod(F.xxhash64(*hashed), n).cast("int")).drop("_parts")
    iv = (intervals.where(meets).withColumn("_bucket", F.explode(F.sequence(bucket(lo), bucket(hi))))
          .join(parts, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), n - 1))).drop("_parts"))
    on.append("_part")
    cond = [iv[k] == pt[k] for k in on] + [pt[point_col] >= iv[lo_col], pt[point_col] <= iv[hi_col]]
    out = iv.join(pt, cond, "inner")
    for k in on:
        out = out.drop(pt[k])
    out = out.drop("_bucket", "_part")
    if how == "left":
        # an interval has no points if none of its copies has; equal intervals, which have equal points, go together
        alone = iv.join(pt, cond, "left_anti").groupBy(*intervals.columns, "_bucket", "_part").agg(F.count(F.lit(1)).alias("_n"))
        alone = alone.join(parts, on[:-1], "left").groupBy(*intervals.columns).agg(
            F.sum(1 / n).alias("_covered"), F.max("_n").alias("_times"))
        whole = F.abs(F.col("_covered") - (bucket(hi) - bucket(lo) + 1)) < 0.5 / POINTS_PER_PART
        none = alone.where(whole).select(*intervals.columns, F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_i"))
        out = out.unionByName(none.drop("_i"), allowMissingColumns=True) \
                 .unionByName(intervals.where(~F.coalesce(meets, F.lit(False))), allowMissingColumns=True)
    return out


def poll_month(polls_curated: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per poll month: mean of each safely-cast value and ``m = count(*)``.

    ``m`` counts every curated poll row of the month, castable or not; it is
    the fan-out factor of the studied join.
    """
    return (polls_curated.where(F.col("period_start").isNotNull())
            .groupBy(*keys, month_start("period_start").alias("month"))
            .agg(*[F.avg(safe_double(c)).alias(c) for c in POLL_VALUES],
                 F.count(F.lit(1)).alias("n_polls")))


def month_bucket_join(spine: DataFrame, polls_curated: DataFrame,
                      keys: Sequence[str] = (), poll_keys: Sequence[str] = ()) -> DataFrame:
    """Weeks joined to the polls of their month, at grain.

    The many-to-many month join is replaced by a join to the per-month
    aggregate, so the output has one row per spine row.
    """
    pm = poll_month(polls_curated, poll_keys)
    return (spine.withColumn("month", month_start("week_start"))
            .join(pm, [*poll_keys, "month"], "left"))


def indicator_month_join(spine: DataFrame, indicators_curated: DataFrame,
                         presence_col: str = PRESENCE_COLUMN) -> DataFrame:
    """Month-key join to indicators plus ``WHERE <presence> IS NOT NULL``.

    The presence test acts on the raw column, so ``'NA'`` passes while a
    missing month (or a raw NULL) drops the week; the left join followed by
    that filter is an inner join.
    """
    ind = indicators_curated.where(F.col(presence_col).isNotNull())
    return (spine.withColumn("month", month_start("week_start"))
            .join(ind.withColumnRenamed("month_start", "month"), "month", "inner"))


# --------------------------------------------------------------------------
# Composite panel
# --------------------------------------------------------------------------

def weekly_panel(events_curated: DataFrame, polls_curated: DataFrame,
                 indicators_curated: DataFrame, as_of, run_ts=None,
                 keys: Sequence[str] = (), fanout: str = "reference",
                 count_col: str = "events_on_date",
                 date_col: str = "publication_date", validate_months: bool = True) -> DataFrame:
    """The weekly panel: spine -> events per week -> polls per month -> indicators.

    ``fanout='reference'`` reproduces the studied query exactly, including its
    join fan-out: the weekly event total is multiplied by the number of polls
    in the week's month (``max(m, 1)``), because events and polls were joined
    to the same week before grouping. ``fanout='corrected'`` gives the true
    weekly count. Neither mode materialises the k x m blow-up.

    ``as_of`` ends the spine; with None it ends with the last week that has
    events, in any series.

    ``keys`` makes it a multi-series panel (events carry the keys; polls and
    indicators are shared by month, as in the studied pipeline).

    ``validate_months`` treats a month that appears twice among the
    indicators as an input error (raised while the join runs, no extra
    action); with ``False`` the duplicate multiplies rows as the literal
    query does.
    """
    if fanout not in ("reference", "corrected"):
        raise ValueError("fanout must be 'reference' or 'corrected'")
    weekly = week_counts(events_curated, date_col, keys,
                         count_col if count_col in events_curated.columns else None)
    if keys:
        spined = fill_weeks(weekly, as_of, keys)
    else:
        spined = spine_join(weekly, as_of)
    pm = poll_month(polls_curated)
    ind = (indicators_curated.where(F.col(PRESENCE_COLUMN).isNotNull())
           .withColumnRenamed("month_start", "month"))
    if validate_months:
        dup = F.count(F.lit(1)).over(Window.partitionBy("month")) > 1
        ind = ind.withColumn("month", F.when(~dup, F.col("month")).otherwise(
            F.raise_error(F.concat(F.lit("duplicate indicator month "), F.col("month").cast("string")))))
    j = (spined.withColumn("month", month_start("week_start"))
         .join(ind, "month", "inner")
         .join(pm, "month", "left"))
    total = F.coalesce(F.col("n_events"), F.lit(0)).cast("bigint")
    if fanout == "reference":
        total = total * F.greatest(F.coalesce(F.col("n_polls"), F.lit(1)), F.lit(1)).cast("bigint")
    run = F.lit(run_ts).cast("timestamp_ntz") if run_ts is not None else F.localtimestamp()
    cols = [*[F.col(k) for k in keys], F.col("week_start"),
            *[F.col(c) for c in POLL_VALUES]]
    for c in INDICATORS:
        cols.append(na_to_null(c).alias(c) if c in INDICATORS_NA else F.col(c))
    cols += [total.alias(OUTCOME), run.alias("run_date")]
    return j.select(*cols)


PANEL_SCHEMA_DDL = ", ".join(
    ["week_start DATE"] + [f"{c} DOUBLE" for c in POLL_VALUES]
    + [f"{c} {'STRING' if c in INDICATORS_NA else 'BIGINT'}" for c in INDICATORS]
    + [f"{OUTCOME} BIGINT", "run_date TIMESTAMP_NTZ"])
