"""Null-model normalisation: sentinels, safe casts, null tests.

Four encodings of "missing" reach us (SQL NULL, the text ``'NA'``, text that
fails a cast, NaN); all are turned into SQL NULL here so aggregates behave.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.constants import NA_SENTINEL
from panelkit.functions.util import col as _c


def na_to_null(c, sentinel: str = NA_SENTINEL) -> Column:
    """``IF(x = 'NA', NULL, x)``."""
    return F.nullif(_c(c), F.lit(sentinel))


def safe_double(c) -> Column:
    """``SAFE_CAST(x AS FLOAT64)``: blanks trimmed, junk -> NULL."""
    return _c(c).try_cast("double")


def safe_long(c) -> Column:
    return _c(c).try_cast("bigint")


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def any_null(cols) -> Column:
    """True when any of ``cols`` is NULL."""
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])
