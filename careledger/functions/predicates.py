"""The four window predicates of the scripts (P7-P11) and the filter
conjunctions (P14-P16).  They are kept apart on purpose: each one treats a
time of day on the boundary days differently.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "in_window_by_date", "in_window_raw", "in_window_half_open", "active_on",
    "overlaps_window", "overlaps_window_by_date", "claimable", "open_period",
    "on_hold", "ts", "same", "differs",
]


def same(x: Column, *values: str) -> Column:
    """T-SQL ``x = value`` (or ``IN``), which ignores trailing blanks.

    The prefix test loses nothing and reaches the scan as a pushed filter;
    the right-trimmed comparison decides."""
    prefix = x.startswith(values[0])
    for v in values[1:]:
        prefix = prefix | x.startswith(v)
    return prefix & F.rtrim(x).isin(*values)


def differs(x: Column, value: str) -> Column:
    """T-SQL ``x <> value``, which ignores trailing blanks."""
    return F.rtrim(x) != value


def ts(d: dt.date) -> Column:
    """A run date as a midnight TIMESTAMP_NTZ literal."""
    return F.lit(d).cast("timestamp_ntz")


def in_window_by_date(x: Column, start: dt.date, end: dt.date) -> Column:
    """P7 ``CAST(x AS date) BETWEEN start AND end`` (whole end day included).

    Written as the equivalent half-open range on the raw column so the
    parquet reader receives both bounds as pushed filters."""
    return (x >= ts(start)) & (x < ts(end + dt.timedelta(days=1)))


def in_window_raw(x: Column, start: dt.date, end: dt.date) -> Column:
    """P8 ``x BETWEEN start AND end`` on the uncast column: the end day only
    counts at 00:00."""
    return (x >= ts(start)) & (x <= ts(end))


def in_window_half_open(x: Column, start: dt.date, end: dt.date) -> Column:
    """P9 ``x >= start AND x < DATEADD(DAY, 1, end)``."""
    return (x >= ts(start)) & (x < ts(end + dt.timedelta(days=1)))


def active_on(soc: Column, dc: Column, d) -> Column:
    """P10 active as of d: ``soc <= d AND (dc IS NULL OR dc > d)``.

    ``d`` may be a date (literal) or a DATE column (the census spine)."""
    dd = ts(d) if isinstance(d, dt.date) else d.cast("timestamp_ntz")
    return (soc <= dd) & (dc.isNull() | (dc > dd))


def overlaps_window(soc: Column, dc: Column, start: dt.date, end: dt.date) -> Column:
    """P11 ``soc <= end AND (dc IS NULL OR dc > start)`` on raw timestamps."""
    return (soc <= ts(end)) & (dc.isNull() | (dc > ts(start)))


def overlaps_window_by_date(soc: Column, dc: Column, start: dt.date, end: dt.date) -> Column:
    """P11 variant ``CAST(soc AS date) <= end AND (dc IS NULL OR CAST(dc AS date) >= start)``."""
    return (soc < ts(end + dt.timedelta(days=1))) & (dc.isNull() | (dc >= ts(start)))


def claimable(prefix: str = "li_") -> Column:
    """P14 ``deleted = 0 AND void = 0 AND includeonclaim = 1``."""
    return ((F.col(f"{prefix}deleted") == 0) & (F.col(f"{prefix}void") == 0)
            & (F.col(f"{prefix}includeonclaim") == 1))


def open_period() -> Column:
    """P14 period variant ``pp_deleted = 0 AND pp_periodEnded = 1``."""
    return (F.col("pp_deleted") == 0) & (F.col("pp_periodEnded") == 1)


def on_hold(export_date: Column, invoice_status: Column) -> Column:
    """P15 ``export IS NULL OR status IN ('HOLD','HELD')``."""
    return export_date.isNull() | same(invoice_status, "HOLD", "HELD")
