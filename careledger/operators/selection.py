"""Exact percentiles by distributed selection.

``percentile`` keeps every different value of a group in one aggregation
buffer: right for day counts, too much for a continuous measure of a hot group.
Here no task ever holds a group:

1. values are counted by (group, value), which reduces before the shuffle;
2. the counts are range-partitioned by (group, value), numbered and written to
   the shared folder, so that both later reads see the same ranges;
3. a running total over the ranges of a group (one row a range and group) tells
   which ranges hold the ranks that are asked for;
4. only those ranges are numbered row by row, in windows no larger than a range,
   and the values at the ranks are picked.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careledger.session import ensure_checkpoint_dir


def _key(names: list[str]) -> Column:
    """Groups by one key that is never null, so that a group without a name keeps its rows."""
    return F.struct(*names) if names else F.struct(F.lit(0))


def exact_percentile(df: DataFrame, groups: list[str], value: str, share: float = 0.5, name: str = "percentile",
                     ranges: int | None = None) -> DataFrame:
    """(groups..., ``name``): the interpolated percentile of ``value`` in every group, as ``percentile_cont`` has it.

    Null values do not count; a group of nulls alone has a null percentile.  Decimals stay decimals (with digits for the
    share), other numbers become doubles.  ``ranges`` is the number of range partitions."""
    if not 0 <= share <= 1:
        raise ValueError("a share lies between 0 and 1")
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/selection-{uuid.uuid4().hex}"
    counts = df.groupBy(_key(groups).alias("g"), F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    wanted = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (counts.repartitionByRange(wanted, "g", "v").withColumn("range", F.spark_partition_id())
     .write.parquet(path))
    counts = spark.read.schema(counts.withColumn("range", F.lit(0)).schema).parquet(path)
    some = counts.where("v IS NOT NULL")

    before = Window.partitionBy("g").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    spans = (some.groupBy("g", "range").agg(F.sum("n").alias("rows"))
             .withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
             .withColumn("total", F.sum("rows").over(whole)))
    # Ranks of the two neighbours, from 0, and how far the percentile lies between them.
    at = (F.col("total") - 1) * F.lit(repr(share)).cast("decimal(20,18)")
    spans = spans.withColumn("low", F.floor(at).cast("long")).withColumn("high", F.ceil(at).cast("long"))
    spans = spans.withColumn("part", at - F.col("low"))
    held = lambda rank: (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("before") + F.col("rows"))
    spans = spans.where(held("low") | held("high")).select("g", "range", "before", "low", "high", "part")

    inside = Window.partitionBy("g", "range").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = some.join(spans, ["g", "range"]).withColumn("upto", F.col("before") + F.sum("n").over(inside))
    is_at = lambda rank: (F.col("upto") - F.col("n") <= F.col(rank)) & (F.col(rank) < F.col("upto"))
    picked = rows.groupBy("g").agg(F.max(F.when(is_at("low"), F.col("v"))).alias("a"),
                                   F.max(F.when(is_at("high"), F.col("v"))).alias("b"), F.first("part").alias("part"))
    if dict(df.dtypes)[value].startswith("decimal"):
        between = F.col("a") + (F.col("b") - F.col("a")) * F.col("part").cast("decimal(7,6)")
    else:
        between = F.col("a") + (F.col("b") - F.col("a")) * F.col("part").cast("double")
    all_groups = counts.select("g").distinct().join(picked.select("g", between.alias(name)), "g", "left")
    return all_groups.select(*[F.col("g")[n].alias(n) for n in groups], name)


def exact_median(df: DataFrame, groups: list[str], value: str, name: str = "median") -> DataFrame:
    """The middle value of every group, or the mean of the two in the middle."""
    return exact_percentile(df, groups, value, 0.5, name)
