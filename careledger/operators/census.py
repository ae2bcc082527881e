"""Date spine (S4) and the spine x episode range join.

The script joins a recursive calendar to every episode on the point-in-time
predicate ``soc <= d AND (dc IS NULL OR dc > d)``: a theta join that Spark
can only run as a broadcast nested loop.  Here each episode instead emits
the census days it is active on, computed from its own dates and clipped to
the window, so no episode is compared with every day: one row for each of them
where the rows themselves are wanted (``daily_census_rows``), two steps per stay
where they are only counted (``daily_census``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from careledger.functions.columns import lit_date
from careledger.functions.predicates import overlaps_window


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from start to end inclusive (``CensusDate``)."""
    return spark.range(1).select(
        F.explode(F.sequence(lit_date(start), lit_date(end), F.expr("INTERVAL 1 DAY"))).alias("CensusDate"))


def _ceil_day(ts: Column) -> Column:
    """First midnight at or after ``ts``."""
    d = F.to_date(ts)
    return F.when(ts == d.cast("timestamp_ntz"), d).otherwise(F.date_add(d, 1))


def _active_days(episodes: DataFrame, start: dt.date, end: dt.date, soc: str, dc: str) -> DataFrame:
    """The stays that touch a day of the window, with the first and last such day.

    Active on day d means ``soc <= d`` (d >= first midnight at/after soc) and
    ``dc IS NULL OR dc > d`` (d <= the midnight before dc's ceiling)."""
    s, e = F.col(soc), F.col(dc)
    first = F.greatest(lit_date(start), _ceil_day(s))
    last = F.when(e.isNull(), lit_date(end)).otherwise(F.least(lit_date(end), F.date_add(_ceil_day(e), -1)))
    cand = episodes.filter(s.isNotNull() & overlaps_window(s, e, start, end))
    return cand.withColumn("_first", first).withColumn("_last", last).filter(F.col("_first") <= F.col("_last"))


def daily_census_rows(episodes: DataFrame, start: dt.date, end: dt.date,
                      soc: str = "epi_SocDate", dc: str = "epi_DischargeDate") -> DataFrame:
    """J7 expanded: one row per (census day, episode) with the episode active on that day."""
    cand = _active_days(episodes, start, end, soc, dc)
    return cand.withColumn("CensusDate", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")


def daily_census(stays: DataFrame, keys: list[str], person: str, start: dt.date, end: dt.date,
                 soc: str = "epi_SocDate", dc: str = "epi_DischargeDate") -> DataFrame:
    """J7 with A3: (CensusDate, keys..., DailyCensus), the different persons with an active stay on each day.

    Rows are as many as stays, not stays times days.  A person's stays within a
    group are cut down to days that no earlier one covers (so each person counts
    once a day), each piece is one step up on its first day and one down after its
    last, and the census is the running sum of the steps by day, filled up to the
    next step.  Stays are first reduced to one for each first day, so a person
    brings at most one row a day of the window; steps are summed before they are
    shuffled."""
    rows = _active_days(stays, start, end, soc, dc).where(F.col(person).isNotNull())
    rows = rows.groupBy(*keys, person, "_first").agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy(*keys, person).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_covered", F.max("_last").over(earlier))
    rows = rows.withColumn("_from", F.greatest("_first", F.date_add("_covered", 1))).where("_from <= _last")
    steps = rows.select(*keys, F.explode(F.array(
        F.struct(F.col("_from").alias("day"), F.lit(1).alias("step")),
        F.struct(F.date_add("_last", 1).alias("day"), F.lit(-1).alias("step")))).alias("s"))
    steps = steps.groupBy(*keys, F.col("s.day").alias("day")).agg(F.sum("s.step").alias("step"))
    by_day = Window.partitionBy(*keys).orderBy("day")
    levels = steps.select(*keys, "day", F.sum("step").over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("DailyCensus"),
                          F.date_add(F.lead("day").over(by_day), -1).alias("upto")).where("DailyCensus > 0")
    return levels.select(F.explode(F.sequence("day", "upto")).alias("CensusDate"), *keys, "DailyCensus")
