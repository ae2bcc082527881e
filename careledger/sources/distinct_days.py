"""Distinct counts that recurring runs add to instead of counting again (A3, A4).

A run over a window of days counts different persons by day and group.  The next
run's window shares all days but one, and the distinct count of a window is not
the sum of its days'.  So each day keeps the exact set of its persons: bitmaps of
``bitmap_construct_agg`` by (group, bucket of ids), one row for each bucket that has
any.  A day's count is the number of its bits; the count over any days is the
number of bits of the union (``bitmap_or_agg``).  Both are exact and combine before
the shuffle.

Days are folders ``day=YYYY-MM-DD`` under one root in a shared folder, each
written whole, so adding a day again replaces it and a run that is repeated after a
failure changes nothing.  What a row holds is bounded: 4 KB for up to 32,768 ids.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.functions.columns import lit_date
from careledger.sources.files import names_in


@dataclass(frozen=True)
class DistinctDays:
    """A store of daily sets: ``keys`` are the groups' columns (strings), persons are whole numbers."""
    spark: SparkSession
    root: str
    keys: tuple[str, ...]

    def days(self) -> set[dt.date]:
        """The days that are stored, with persons or without."""
        return {dt.date.fromisoformat(n[4:]) for n in names_in(self.spark, self.root) if n.startswith("day=")
                if "_SUCCESS" in names_in(self.spark, f"{self.root}/{n}")}

    def add(self, rows: DataFrame, day: dt.date, person: str) -> None:
        """Store one day: ``rows`` are the (keys..., person) that were active on it."""
        sets = (rows.where(F.col(person).isNotNull()).withColumn("_id", F.col(person).cast("long"))
                .groupBy(*self.keys, F.bitmap_bucket_number("_id").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("ids")))
        sets.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root.rstrip('/')}/day={day.isoformat()}")

    def _sets(self, start: dt.date, end: dt.date) -> DataFrame:
        fields = ", ".join(f"`{k}` string" for k in self.keys)
        stored = self.spark.read.schema(f"{fields}, bucket long, ids binary, day date").parquet(self.root)
        return stored.where(F.col("day").between(lit_date(start), lit_date(end)))

    def by_day(self, start: dt.date, end: dt.date, name: str = "n") -> DataFrame:
        """(day, keys..., ``name``): different persons on each stored day of the window."""
        return self._sets(start, end).groupBy("day", *self.keys).agg(F.sum(F.bitmap_count("ids")).alias(name))

    def over(self, start: dt.date, end: dt.date, name: str = "n") -> DataFrame:
        """(keys..., ``name``): different persons on any stored day of the window."""
        union = self._sets(start, end).groupBy(*self.keys, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
        return union.groupBy(*self.keys).agg(F.sum(F.bitmap_count("ids")).alias(name))


def census_by_stored_days(store: DistinctDays, active_on_day, start: dt.date, end: dt.date, person: str,
                          again: int = 1) -> DataFrame:
    """K05's window from the store: days that are not stored yet, and the last ``again`` ones (their stays may have
    changed since), are added first; ``active_on_day(day)`` gives the rows that are active on a day."""
    there = store.days()
    for n in range((end - start).days + 1):                     # a run's days: bounded by its parameters
        day = start + dt.timedelta(days=n)
        if day not in there or (end - day).days < again:
            store.add(active_on_day(day), day, person)
    return store.by_day(start, end, "DailyCensus").withColumnRenamed("day", "CensusDate")
