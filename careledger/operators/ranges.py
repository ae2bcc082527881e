"""Points in ranges of the same key, by time bins.

Joined on the key alone, a key with many points (an episode with a long
history) is one task, and every range meets every point of its key.  Here
ranges are cut into bins of ``width`` days and points fall into one bin each, so
the join key is (key, bin): a hot key is spread over its bins, and a range
meets the points of its own bins alone.  Points are counted by (key, day) before
they are shuffled, so a bin holds at most ``width`` rows a key, whatever the
number of points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bin(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(width)).cast("int")


def count_in_ranges(points: DataFrame, ranges: DataFrame, width: int = 32) -> DataFrame:
    """(id, n): how many points lie in each range, ends included; ranges without points have no row.

    ``points``: (key, day); ``ranges``: (id, key, first, last), days as dates.  Ranges that end before they begin, and
    null keys or days, hold and are in nothing."""
    if width < 1:
        raise ValueError("a bin has one day or more")
    days = points.where("key IS NOT NULL AND day IS NOT NULL").groupBy("key", "day").agg(F.count(F.lit(1)).alias("n"))
    days = days.withColumn("bin", _bin(F.col("day"), width))
    pieces = ranges.where("key IS NOT NULL AND first <= last").withColumn(
        "bin", F.explode(F.sequence(_bin(F.col("first"), width), _bin(F.col("last"), width))))
    hits = pieces.join(days, ["key", "bin"]).where(F.col("day").between(F.col("first"), F.col("last")))
    return hits.groupBy("id").agg(F.sum("n").alias("n"))
