"""Scalar column helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "lit_date", "fill", "label_or_code", "blank_to_null", "norm_key", "flag_in",
    "days_between", "hour_boundaries", "ratio_pct", "avg_dec", "bucket_rank",
    "clip_start", "clip_end", "zero_floor", "as_flag", "aging_sums", "RECERT_YES", "AGING_BUCKETS",
]

# Receivables aging buckets (days, inclusive bounds; None = open end).
AGING_BUCKETS = [("ar_0_30", None, 30), ("ar_31_60", 31, 60), ("ar_61_90", 61, 90), ("ar_over_90", 91, None)]

# Recert flag spellings that mean "yes" (compared upper-cased and trimmed).
RECERT_YES = ["Y", "1", "R", "RECERT", "TRUE"]


def lit_date(d: dt.date) -> Column:
    """A run date as a DATE literal (constant-folded by Catalyst)."""
    return F.lit(d).cast("date")


def fill(c: Column, value) -> Column:
    """F1 ``ISNULL(x, literal)`` -> ``coalesce``."""
    return F.coalesce(c, F.lit(value))


def blank_to_null(c: Column) -> Column:
    """F4 ``NULLIF(LTRIM(RTRIM(x)), '')``."""
    return F.when(F.trim(c) != "", F.trim(c))


def label_or_code(name: Column, code: Column, default: str = "(no branch)") -> Column:
    """F2 ``ISNULL(name, ISNULL(NULLIF(LTRIM(RTRIM(code)),''), default))``."""
    return F.coalesce(name, blank_to_null(code), F.lit(default))


def norm_key(c: Column) -> Column:
    """F6 key normalisation: T-SQL ``=`` ignores trailing blanks, Spark does not."""
    return F.rtrim(c)


def flag_in(c: Column, values=RECERT_YES, null_as_blank: bool = False) -> Column:
    """F7 ``UPPER(LTRIM(RTRIM(x))) IN (...)``; NULL input gives NULL unless
    ``null_as_blank`` (``ISNULL(x,'')``) is set."""
    src = F.coalesce(c, F.lit("")) if null_as_blank else c
    return F.upper(F.trim(src)).isin(list(values))


def as_flag(cond: Column) -> Column:
    """F5 ``CASE WHEN cond THEN 1 ELSE 0 END`` (NULL condition -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def days_between(a, b) -> Column:
    """F12 ``DATEDIFF(DAY, a, b)``: midnights crossed from a to b."""
    return F.datediff(_col(b), _col(a))


def hour_boundaries(a, b) -> Column:
    """F13 ``DATEDIFF(HOUR, a, b)``: hour boundaries crossed, not elapsed hours.

    Whole days times 24 plus the difference of the hour fields; exact on
    TIMESTAMP_NTZ, so no time zone can shift it.
    """
    a, b = _col(a), _col(b)
    return F.datediff(b, a) * 24 + F.hour(b) - F.hour(a)


def ratio_pct(num: Column, den: Column, dtype: str, guard: str = "nullif") -> Column:
    """A12 percentage ``num * 100.0 / den`` cast to a fixed decimal (half up).

    guard: ``nullif`` -> NULL when den = 0; ``positive`` -> NULL unless den > 0;
    ``zero`` -> 0 when den = 0.
    """
    raw = num * F.lit(100.0).cast("decimal(4,1)") / F.nullif(den, F.lit(0))
    if guard == "positive":
        raw = F.when(den > 0, num * F.lit(100.0).cast("decimal(4,1)") / den)
    elif guard == "zero":
        raw = F.when(den == 0, F.lit(0)).otherwise(raw)
    return raw.cast(dtype)


def avg_dec(c: Column, dtype: str) -> Column:
    """A9 ``CAST(AVG(x * 1.0) AS decimal(p,s))``: decimal mean, half up.

    The sum is taken as decimal(20,0) so the quotient keeps 18 decimal
    places (decimal(38,0) would leave 6, and a mean within 5e-7 of a tie could
    round twice once counts reach the millions)."""
    return (F.sum(c).cast("decimal(20,0)") / F.count(c)).cast(dtype)


def bucket_rank(service_line: Column, hospice_rank: bool = True) -> Column:
    """F5 rank of a service line: HOME HEALTH 1, HOSPICE 2, else 99."""
    from careledger.sources.dims import HOME_HEALTH, HOSPICE, UNMATCHED_RANK
    expr = F.when(service_line == HOME_HEALTH, 1)
    if hospice_rank:
        expr = expr.when(service_line == HOSPICE, 2)
    return expr.otherwise(UNMATCHED_RANK)


def clip_start(soc: Column, start: dt.date) -> Column:
    """F16 lower end ``CASE WHEN soc > start THEN soc ELSE start END``."""
    s = F.lit(start).cast("timestamp_ntz")
    return F.when(soc > s, soc).otherwise(s)


def clip_end(dc: Column, end: dt.date) -> Column:
    """F16 upper end: end + 1 day when open or after end, else the discharge.

    Compares the raw timestamp with the end date, so a discharge at 10:00 on
    the end day becomes end + 1 (``least`` would lose that day)."""
    e = F.lit(end).cast("timestamp_ntz")
    return F.when(dc.isNull() | (dc > e), F.lit(end + dt.timedelta(days=1)).cast("timestamp_ntz")).otherwise(dc)


def zero_floor(c: Column) -> Column:
    """A20 ``CASE WHEN d > 0 THEN d ELSE 0 END``."""
    return F.when(c > 0, c).otherwise(F.lit(0))


def aging_sums(age: Column, amount: Column, total: str = "ar_total") -> list[Column]:
    """A8 aging pivot: one conditional sum per bucket plus the total, in one
    aggregation (``SUM(CASE WHEN age BETWEEN lo AND hi THEN amount ELSE 0 END)``)."""
    out = []
    for name, lo, hi in AGING_BUCKETS:
        cond = (age >= lo) if hi is None else (age <= hi) if lo is None else age.between(lo, hi)
        out.append(F.sum(F.when(cond, amount).otherwise(F.lit(0))).alias(name))
    return out + [F.sum(amount).alias(total)]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
