"""Operator 8, sharding by sampled splitters (DataFrame functions only).

Rows are ordered by a content key and their id, so equal texts stand next to
each other.  A key sample, drawn with probability in proportion to the row
size, gives quantile boundaries; they cut the order into ranges, and every
range whose measured size or row count is too large is cut again by boundaries
sampled from that range alone, until none is left (a hot text is cut by id, and rows
that agree in both by the number they got when they were read).  Running sums inside
the ranges and over the few range totals then give every row its exact place
in the global order, and the shard is the one whose equal share of the total
bytes holds the row's middle byte.  The ranges only spread the work: the result
does not depend on the sample.

Defined results: law ``bytes``.  A null text counts 0 bytes (plus the fixed
``overhead``) and has checksum 0; null ids sort first; repeated rows
are interchangeable and take neighbouring slots.  An empty table gives an
empty result.  Shard sizes differ by less than one row from the equal share at
either boundary.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careledger.llm.common import stored

#: Draws a range, rows that a range should hold, and ranges that are cut at a time: bounds of the sample on the driver
#: (16 bytes a draw and cut) and of a task's share; a table of more than MOST_RANGES * RANGE_ROWS rows has larger ranges.
DRAWS, RANGE_ROWS, MOST_RANGES = 32, 200_000, 8_192
ROUNDS = 12             # times that overfull ranges are cut again


Key = tuple[int, int | None, int]


def _ordered(key: Key) -> tuple:
    """Keys in Spark's order: a null id comes first."""
    k, i, r = key
    return k, i is not None, i or 0, r


def _range_of(cuts: list[Key]) -> Column:
    """How many of the sorted ``cuts`` are not over a row's (k, id, row): a binary search in one constant array."""
    if not cuts:
        return F.lit(0)
    # One literal text, folded to an array when the plan is made: its cost does not grow with expressions.
    table = F.from_json(F.lit(json.dumps([{"k": k, "i": i, "r": r} for k, i, r in cuts])), "array<struct<k:long,i:long,r:long>>")
    here = F.struct(F.col("k").alias("k"), F.col("id").alias("i"), F.col("row").alias("r"))

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["lo"] + span["hi"], 1)
        right = F.element_at(table, middle + 1) <= here
        open_ = span["lo"] < span["hi"]
        return F.struct(F.when(open_ & right, middle + 1).otherwise(span["lo"]).alias("lo"),
                        F.when(open_ & ~right, middle).otherwise(span["hi"]).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), halve, lambda span: span["lo"])


def _splitters(rows: DataFrame, ranges: int, total: int, seed: int) -> list[Key]:
    """Quantile boundaries of a size-weighted sample of about ``ranges * DRAWS`` keys, and at most as many."""
    chance = F.pmod(F.xxhash64("k", "id", "row", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    weight = F.col("size") * F.lit(ranges * DRAWS / max(1, total))
    drawn = rows.where(chance < weight).select("k", "id", "row").collect()   # bounded: MOST_RANGES * DRAWS keys or about
    drawn = sorted({(r.k, r.id, r.row) for r in drawn}, key=_ordered)
    return sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}, key=_ordered) if drawn else []


def range_cuts(rows: DataFrame, shards: int, n: int, total: int) -> list[Key]:
    """Boundaries of ranges of like size: sampled splitters, then again inside every range that is too full, until
    none is or nothing is left to cut."""
    ranges = min(max(2 * shards, math.ceil(n / RANGE_ROWS)), MOST_RANGES)
    cuts, most_bytes, most_rows = _splitters(rows, ranges, total, 1), 2 * total / ranges, 2 * max(RANGE_ROWS, n / ranges)
    for seed in range(2, 2 + ROUNDS):
        sizes = rows.groupBy(_range_of(cuts).alias("r")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
        # A range of one row cannot be cut.
        full = {r.r: r for r in sizes.where(((F.col("b") > most_bytes) | (F.col("n") > most_rows)) & (F.col("n") > 1)).collect()}
        if not full:
            break
        part = rows.where(_range_of(cuts).isin(list(full)))
        pieces = max(2, math.ceil(sum(max(r.b / most_bytes, r.n / most_rows) for r in full.values())) * 4)
        more = _splitters(part, min(pieces, MOST_RANGES), sum(r.b for r in full.values()), seed)
        keys = [_ordered(c) for c in cuts]
        more = [m for m in more if bisect_right(keys, _ordered(m)) in full]
        before = len(cuts)
        cuts = sorted({*cuts, *more}, key=_ordered)
        if len(cuts) == before and seed > 3:
            break
    return cuts


def assign_shards(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (k long, id long, row long, size long, ...) with ``shard`` and ``slot``; (k, id, row) is their order."""
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).first()
    n, total = whole.n, whole.b or 0
    if n == 0:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    cuts = range_cuts(rows, shards, n, total)
    ranged = rows.withColumn("range", _range_of(cuts))
    # Exact places: range totals (one row a range) carry the sums before each range.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("range").agg(F.sum("size").alias("b"))
               .select("range", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0")))
    inside = Window.partitionBy("range").orderBy("k", "id", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.withColumn("b_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(offsets, "range")
              .withColumn("middle", 2 * (F.col("b0") + F.col("b_in")) + F.col("size"))
              .withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"cast(middle * {shards} div {2 * max(1, total)} as int)"))))
    placed = stored(placed.drop("b0", "b_in", "middle"), "shard-rows")
    per = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("shard", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"))
    order = Window.partitionBy("shard", "range").orderBy("k", "id", "row")
    return (placed.join(starts, ["shard", "range"])
            .withColumn("slot", F.col("n0") + F.row_number().over(order) - 1)
            .drop("n0", "range"))


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.col(text_col)
    rows = stored(docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("k"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("row")), "shard-keys")
    return assign_shards(rows, shards).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> None:
    """The records themselves, one folder a shard, in files of ``RANGE_ROWS`` slots in order (ids must be unique)."""
    placed = shard_documents(docs, shards, 16, id_col, text_col).select(F.col("doc_id").alias(id_col), "shard", "slot")
    piece = F.floor(F.col("slot") / RANGE_ROWS)
    (docs.join(placed, id_col).repartition("shard", piece).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
