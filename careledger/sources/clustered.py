"""Physical layout for window reports: tables clustered by the date their windows test.

``layout.py`` puts an episode's rows together; this one puts a month's (or a
day's) rows together, for tables that are too large to be read for 15 days.
Each table is partitioned by the month of one date column, which is also what
its rows are sorted by, so a window reads the files of its months and, in them,
the row groups of its days.  Hot months are split and small ones joined by the
rebalance that comes before the write, so files have about one size.

Episodes are clustered by the month of discharge.  Open stays (no discharge) are
the partition without a month: a point-in-time or overlap predicate
``soc <= d AND (dc IS NULL OR dc > d)`` has no lower bound on ``soc``, but reads
only the open stays and those that were closed in d's month or later.

Reports say which days they need with ``within`` and ``open_or_closed_after``;
on tables without this layout those change nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.functions.columns import lit_date
from careledger.sources.catalog import Catalog

# table -> the date column that its rows are clustered by
CLUSTERED_BY = {
    "episodes": "epi_DischargeDate",
    "line_items": "li_servicedate",
    "invoices": "i_postdate",
    "visits_all": "cev_visitdate",
    "visits": "cev_visitdate",
    "pdgm_period": "pp_endDate",
}
UNITS = {"month": "MM", "day": "DD"}


def _part(column: str, unit: str) -> str:
    return f"{column}__{unit}"


def _cluster_of(df: DataFrame, column: str) -> tuple[str, str] | None:
    return next(((_part(column, u), u) for u in UNITS if _part(column, u) in df.columns), None)


def _unit_start(day: dt.date, unit: str) -> dt.date:
    return day.replace(day=1) if unit == "month" else day


def within(df: DataFrame, column: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Only the partitions that can hold rows with ``column`` on the days from ``start`` to ``end`` (None: open end)."""
    found = _cluster_of(df, column)
    if found is None:
        return df
    part, unit = found
    if start is not None:
        df = df.filter(F.col(part) >= lit_date(_unit_start(start, unit)))
    if end is not None:
        df = df.filter(F.col(part) <= lit_date(_unit_start(end, unit)))
    return df.drop(part)


def open_or_closed_after(df: DataFrame, column: str, day: dt.date) -> DataFrame:
    """Only the open rows (``column`` is null) and the partitions that can hold rows closed on ``day`` or later."""
    found = _cluster_of(df, column)
    if found is None:
        return df
    part, unit = found
    return df.filter(F.col(part).isNull() | (F.col(part) >= lit_date(_unit_start(day, unit)))).drop(part)


def write_clustered(df: DataFrame, path: str, column: str, unit: str = "month") -> None:
    """One table, partitioned by the unit of ``column``, sorted by it in every file."""
    part = _part(column, unit)
    day = F.to_date(column)
    rows = df.withColumn(part, F.trunc(day, "MM") if unit == "month" else day)
    (rows.hint("rebalance", part).sortWithinPartitions(part, column)
     .write.mode("overwrite").partitionBy(part).parquet(path))


def materialize_clustered(cat: Catalog, root: str, unit: str = "month", tables: list[str] | None = None) -> Catalog:
    """Write the catalog's tables (or those of ``tables``; the others stay as they are) under ``root``, a shared
    folder, and return a catalog over the written ones."""
    if unit not in UNITS:
        raise ValueError(f"a cluster unit is one of {', '.join(UNITS)}")
    spark, out, root = cat.spark, {}, root.rstrip("/")
    for f in fields(cat):
        df = getattr(cat, f.name)
        if f.name == "spark" or (tables is not None and f.name not in tables):
            out[f.name] = df
            continue
        if f.name == "visits" and df is cat.visits_all and "visits_all" in out:
            out[f.name] = out["visits_all"]                     # one table under two names
            continue
        path = f"{root}/{f.name}"
        if f.name in CLUSTERED_BY:
            write_clustered(df, path, CLUSTERED_BY[f.name], unit)
        else:
            df.write.mode("overwrite").parquet(path)
        out[f.name] = spark.read.parquet(path)
    return Catalog(**out)
