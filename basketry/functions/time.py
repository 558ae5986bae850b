"""Epoch-second time arithmetic (D1-D4, F3 bounds).

Timestamps in the behaviour log are integer epoch seconds; calendar days and
hours are derived with plain integer arithmetic at a fixed UTC offset, so the
results never depend on the session or host time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# Fixed values (must match the upstream conventions):
SECONDS_PER_DAY = 86400
KST_OFFSET = 32400        # UTC+9: the business day used by date-range filters and click days
DAY_SPLIT_OFFSET = 18000  # UTC+5: clock on which an order's "yesterday" is decided
LATE_HOUR = 4             # orders at 04:xx on that clock look back two days

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds(col: str | Column, dtype: T.DataType) -> Column:
    """Whole epoch seconds of a timestamp column, independent of the session zone.

    ``TIMESTAMP_NTZ`` values are read as UTC wall-clock, ``TIMESTAMP`` values
    are instants already.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(c)
    return c.cast("long")


def date_range_bounds(start: str, end: str, offset: int = KST_OFFSET) -> tuple[int, int]:
    """Epoch bounds of the local days ``start`` .. ``end`` (ISO dates) at UTC+offset.

    The upper bound is midnight *after* the last day; :func:`filter_by_timestamp`
    keeps both bounds inclusive, as the original job does.
    """
    d0 = _dt.date.fromisoformat(start)
    d1 = _dt.date.fromisoformat(end) + _dt.timedelta(days=1)
    epoch = _dt.date(1970, 1, 1)
    return ((d0 - epoch).days * SECONDS_PER_DAY - offset,
            (d1 - epoch).days * SECONDS_PER_DAY - offset)


def local_day(ts: str | Column, offset: int) -> Column:
    """Days since 1970-01-01 of the local date at UTC+offset (floor division)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor((c + F.lit(offset)) / F.lit(SECONDS_PER_DAY)).cast("long")


def local_hour(ts: str | Column, offset: int) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.pmod(c + F.lit(offset), F.lit(SECONDS_PER_DAY)) / F.lit(3600)).cast("int")


def yesterday_day(ts: str | Column, split_offset: int = DAY_SPLIT_OFFSET, late_hour: int = LATE_HOUR) -> Column:
    """The local day whose clicks feed an order placed at ``ts``.

    On the UTC+``split_offset`` clock go back one day, or two when the order was
    placed during hour ``late_hour``.
    """
    back = F.when(local_hour(ts, split_offset) == late_hour, F.lit(2)).otherwise(F.lit(1))
    return local_day(ts, split_offset) - back


def click_day(ts: str | Column, bounds_offset: int = KST_OFFSET) -> Column:
    """The local day (midnight..23:59:59 at UTC+``bounds_offset``) a click falls in."""
    return local_day(ts, bounds_offset)
