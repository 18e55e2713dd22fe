"""Validity periods, indicator flags and dates.

``*_DTM`` columns are ``TIMESTAMP_NTZ``: the sentinels 0001-01-01 and
9999-12-31 are valid there, and no session time zone shifts them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, col_, normalise

# Open end of a validity period and unknown begin.
OPEN_END = "9999-12-31"
UNKNOWN_BEGIN = "0001-01-01"


def date_lit(value: str | _dt.date) -> Column:
    return F.lit(str(value)).cast("date")


def to_date(c: ColumnLike) -> Column:
    return col_(c).cast("date")


def to_dtm(c: ColumnLike) -> Column:
    """Date or timestamp to ``TIMESTAMP_NTZ`` (a date becomes midnight)."""
    return col_(c).cast("timestamp_ntz")


def is_open(end_dt: ColumnLike) -> Column:
    return F.coalesce(col_(end_dt) == date_lit(OPEN_END), F.lit(False))


def bounds(begin: ColumnLike | None, end: ColumnLike | None,
           default_begin: str | None = None,
           default_end: str | None = OPEN_END) -> dict[str, Column]:
    """The validity quartet ``begin_dt, begin_dtm, end_dt, end_dtm``.

    A missing bound takes its default (``None`` keeps NULL).  ``end_dtm``
    follows the end date, ``begin_dtm`` the begin date.
    """
    def _d(c, default):
        if c is None:
            return date_lit(default) if default else F.lit(None).cast("date")
        d = to_date(c)
        return F.coalesce(d, date_lit(default)) if default else d

    b = _d(begin, default_begin)
    e = _d(end, default_end)
    return {"begin_dt": b, "begin_dtm": to_dtm(b), "end_dt": e, "end_dtm": to_dtm(e)}


def to_boolean(c: ColumnLike) -> Column:
    """Indicator text to BOOLEAN: T/TRUE/Y/YES/1 true, F/FALSE/N/NO/0 false,
    anything else NULL (never an error, unlike an ANSI cast)."""
    n = normalise(c)
    return (F.when(n.isin("T", "TRUE", "Y", "YES", "1"), F.lit(True))
             .when(n.isin("F", "FALSE", "N", "NO", "0"), F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))


def yes_no_to_boolean(c: ColumnLike) -> Column:
    """Only 'Y'/'N' (any case, padded) are valid; every other value is NULL."""
    n = normalise(c)
    return (F.when(n == "Y", F.lit(True)).when(n == "N", F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))


def expired(end: ColumnLike, as_of: str | _dt.date) -> Column:
    """``end < as_of`` as a non-NULL boolean (NULL end counts as not expired)."""
    return F.coalesce(col_(end) < date_lit(as_of), F.lit(False))
