"""Date parsing and calendar arithmetic as built-in Column expressions.

All functions return ``pyspark.sql.Column`` and stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.constants import SNAPSHOT_WEEKDAY as FRIDAY_WEEKDAY
from panelkit.constants import TWO_DIGIT_PIVOT_YEAR
from panelkit.functions.util import col as _c

# Weeks start on Sunday; poll dates come as M/d/yy, M/d/yyyy or a broken
# M/d/y/yyy. The pivot year and anchor weekday are in panelkit.constants.


def sunday_week(d) -> Column:
    """Start (Sunday) of the week containing ``d``; a Sunday maps to itself.

    Spark's ``date_trunc('week')`` starts weeks on Monday, hence the
    explicit arithmetic. ``dayofweek`` is 1 for Sunday.
    """
    d = _c(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def month_start(d) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(_c(d), "MM")


def week_end(week_start) -> Column:
    """Last day (Saturday) of a Sunday-started week."""
    return F.date_add(_c(week_start), 6)


def parse_month_year(month, year) -> Column:
    """First day of a month given as two texts; NULL if either is NULL, an error if they name no month."""
    return F.to_date(F.concat(_c(month), F.lit("-"), _c(year)), "M-yyyy")


def pivot_two_digit_year(d) -> Column:
    """Move a date parsed with Spark's ``yy`` (always 20xx) onto the POSIX pivot."""
    d = _c(d)
    return F.when(F.year(d) >= TWO_DIGIT_PIVOT_YEAR, F.add_months(d, -1200)).otherwise(d)


def repair_extra_slash(s) -> Column:
    """Drop the third slash: ``'1/10/2/021'`` -> ``'1/10/2021'``; no-op otherwise."""
    return F.regexp_replace(_c(s), r"^([^/]*/[^/]*/[^/]*)/", "$1")


def parse_poll_date(s, repair: bool = True) -> Column:
    """First layout that parses: ``M/d/yy``, ``M/d/yyyy``, repaired ``M/d/y/yyy``.

    Without ``repair`` the third layout gives NULL.
    """
    t = F.trim(_c(s))
    # Each parse is guarded by the digit shape it needs: a failed parse costs
    # a swallowed exception per row, the regex test is cheap. The guards only
    # skip attempts that cannot succeed ('yy' takes exactly two year digits,
    # 'yyyy' four or more), so results are unchanged.
    short = F.when(t.rlike(r"^[0-9]+/[0-9]+/[0-9]{2}$"),
                   pivot_two_digit_year(F.try_to_date(t, "M/d/yy")))
    long_ = F.when(t.rlike(r"^[0-9]+/[0-9]+/[0-9]{4,}$"), F.try_to_date(t, "M/d/yyyy"))
    if repair:
        fixed = repair_extra_slash(t)
        third = F.when(t.rlike(r"^[0-9]+/[0-9]+/[0-9]*/[0-9]*"),
                       F.when(fixed.rlike(r"^[0-9]+/[0-9]+/[0-9]{4,}$"), F.try_to_date(fixed, "M/d/yyyy")))
    else:
        third = long_
    return F.coalesce(short, long_, third)


def most_recent_friday(d) -> Column:
    """The Friday on or before ``d`` (a Friday maps to itself)."""
    d = _c(d)
    return F.date_sub(d, F.pmod(F.weekday(d) - F.lit(FRIDAY_WEEKDAY), F.lit(7)))


def date_label(d, fmt: str = "yyyy-MM-dd") -> Column:
    """strftime-style label; ``yyyyMMdd`` for compact snapshot names."""
    return F.date_format(_c(d), fmt)


def slash_to_dash(s) -> Column:
    return F.replace(_c(s), F.lit("/"), F.lit("-"))


def weeks_between(later, earlier) -> Column:
    """Whole weeks between two Sunday-aligned dates."""
    return F.floor(F.datediff(_c(later), _c(earlier)) / 7).cast("int")
