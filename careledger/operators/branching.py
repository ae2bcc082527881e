"""Joins of fact rows to the branch dimension (J1-J4) and the
group -> label -> rank step shared by most reports (A1, A10, F1).

The branch dimension is a site table of a few dozen rows (one per branch
office); it is broadcast only when its row count is bounded (see
``bounded_broadcast``), so no fact ever shuffles to meet it.
"""

from __future__ import annotations

import datetime as dt
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.functions.columns import bucket_rank, fill, label_or_code, lit_date, norm_key
from careledger.sources.collation import one_spelling

UNMAPPED = "(unmapped)"

# Row bounds under which a code table / dimension is broadcast.  Above the
# bound the join is left to the planner (sort-merge, or a broadcast chosen
# by AQE from runtime sizes), so a dimension that grows is never shipped
# whole to every executor.
BRANCH_DIM_MAX_ROWS = 10_000
CODE_TABLE_MAX_ROWS = 100_000

_SIZE_CHECKS: "WeakKeyDictionary[DataFrame, dict[int, bool]]" = WeakKeyDictionary()


def within_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows.

    Reads at most ``max_rows + 1`` rows, once per DataFrame object and bound
    (a catalog's dimension is checked once per run, not once per report).
    The answer only picks the join strategy, never the result."""
    checks = _SIZE_CHECKS.setdefault(df, {})
    if max_rows not in checks:
        checks[max_rows] = df.limit(max_rows + 1).count() <= max_rows
    return checks[max_rows]


def bounded_broadcast(source: DataFrame, max_rows: int, projected: DataFrame | None = None) -> DataFrame:
    """Broadcast ``projected`` (default ``source``) if ``source`` is within
    ``max_rows`` rows; otherwise return it unhinted."""
    out = source if projected is None else projected
    return F.broadcast(out) if within_rows(source, max_rows) else out


def branch_dim(dim: DataFrame, max_rows: int = BRANCH_DIM_MAX_ROWS) -> DataFrame:
    """The dimension with a normalised join key and the rank column."""
    return bounded_broadcast(dim, max_rows, _dim_rows(dim))


def _dim_rows(dim: DataFrame) -> DataFrame:
    return dim.select(
        F.col("epi_slid").alias("_dim_slid"),
        norm_key(F.col("epi_branchcode")).alias("_dim_code"),
        F.col("branch_name").alias("bucket"),
        F.rtrim("service_line").alias("_dim_service_line"),
    )


def _join_wildcard(df: DataFrame, dim: DataFrame, slid: str, code: str) -> DataFrame:
    """The left join on ``line = line AND (dim.code IS NULL OR dim.code = code)`` as two equi-joins.

    Branches with a code meet the facts on (line, code), so above the
    broadcast bound they hash on both; branches without one are one row per
    line, joined on the line.  The matches of both are the row's branches."""
    branch = F.struct("bucket", "_dim_service_line")
    rows = _dim_rows(dim)
    coded = rows.where(F.col("_dim_code").isNotNull()).groupBy("_dim_slid", "_dim_code").agg(
        F.collect_list(branch).alias("_coded"))
    whole = rows.where(F.col("_dim_code").isNull()).groupBy(F.col("_dim_slid").alias("_line_slid")).agg(
        F.collect_list(branch).alias("_whole"))
    coded = bounded_broadcast(dim, BRANCH_DIM_MAX_ROWS, coded)
    whole = bounded_broadcast(dim, BRANCH_DIM_MAX_ROWS, whole)
    out = df.join(coded, (coded["_dim_slid"] == F.col(slid)) & (coded["_dim_code"] == norm_key(F.col(code))), "left")
    out = out.join(whole, whole["_line_slid"] == F.col(slid), "left")
    none = F.array().cast(coded.schema["_coded"].dataType)
    found = F.concat(F.coalesce("_coded", none), F.coalesce("_whole", none))
    return (out.withColumn("_branch", F.explode_outer(found))
            .withColumns({"bucket": F.col("_branch.bucket"), "_dim_service_line": F.col("_branch._dim_service_line")})
            .drop("_branch", "_coded", "_whole", "_line_slid"))


def with_bucket(df: DataFrame, dim: DataFrame, slid: str = "epi_slid",
                code: str = "epi_branchcode", wildcard: bool = False,
                hospice_rank: bool = True, keep_service_line: bool = False) -> DataFrame:
    """Left join on service line + branch code, add ``bucket`` and ``bucket_sort``.

    ``wildcard`` gives the ``(map.code IS NULL OR map.code = e.code)`` form:
    a dimension row without a code matches every branch of its line."""
    if wildcard:
        out = _join_wildcard(df, dim, slid, code)
    else:
        d = branch_dim(dim)
        out = df.join(d, (d["_dim_slid"] == F.col(slid)) & (d["_dim_code"] == norm_key(F.col(code))), "left")
    out = out.withColumn(
        "bucket_sort", bucket_rank(F.col("_dim_service_line"), hospice_rank))
    drop = ["_dim_slid", "_dim_code"] + ([] if keep_service_line else ["_dim_service_line"])
    return out.drop(*drop)


def with_branch_by_code(df: DataFrame, dim: DataFrame, code: str = "branch_code") -> DataFrame:
    """Left join on branch code only; adds ``branch_name`` and ``service_line``."""
    d = branch_dim(dim).select(
        F.col("_dim_code"), F.col("bucket").alias("branch_name"),
        F.col("_dim_service_line").alias("service_line"))
    return df.join(d, d["_dim_code"] == norm_key(F.col(code)), "left").drop("_dim_code")


def order_bounded(df: DataFrame, *cols) -> DataFrame:
    """ORDER BY for a result bounded by the branch dimension (one row per
    bucket or per bucket x code class: dozens of rows, never fact-sized).

    A global ``orderBy`` range-partitions, which costs a sampling job; here
    the aggregate still runs on all shuffle partitions and only its tiny
    result moves to one partition to be sorted."""
    return df.repartition(1).sortWithinPartitions(*cols)


def window_cols(start: dt.date, end: dt.date) -> list[Column]:
    """P3 ``@StartDate AS window_start, @EndDate AS window_end``."""
    return [lit_date(start).alias("window_start"), lit_date(end).alias("window_end")]


def by_bucket(df: DataFrame, aggs: list[Column], consts: list[Column] | None = None,
              label: bool = True, order: str | None = "rank") -> DataFrame:
    """Group on the raw nullable bucket, take ``MIN(bucket_sort)``, then label.

    All rows without a branch form one NULL group, labelled ``(unmapped)``
    after grouping.  ``order``: ``rank`` (bucket_sort, bucket), ``bucket``
    (bucket only) or None."""
    g = df.groupBy("bucket").agg(F.min("bucket_sort").alias("bucket_sort"), *aggs)
    names = [c for c in g.columns if c not in ("bucket", "bucket_sort")]
    bucket = fill(F.col("bucket"), UNMAPPED).alias("bucket") if label else F.col("bucket")
    out = g.select(bucket, "bucket_sort", *(consts or []), *names)
    if order == "rank":
        out = order_bounded(out, "bucket_sort", "bucket")
    elif order == "bucket":
        out = order_bounded(out, "bucket")
    return out


def by_branch_code(df: DataFrame, dim: DataFrame, aggs: list[Column], consts: list[Column],
                   default_label: str | None = None) -> DataFrame:
    """Billing shape (K04, K28-K30): group by branch code + name + line.

    Branch codes are grouped after right-trimming, as T-SQL compares
    ``'B01'`` and ``'B01  '`` equal.  ``default_label`` None labels by F2
    (name, else non-blank code, else ``(no branch)``); a string labels
    unmatched rows with it."""
    j = with_branch_by_code(df.withColumn("branch_code", norm_key(F.col("branch_code"))), dim)
    g = j.groupBy("branch_code", "branch_name", "service_line").agg(*aggs, one_spelling("branch_code").alias("_spelt"))
    names = [c for c in g.columns if c not in ("branch_code", "branch_name", "service_line", "_spelt")]
    bucket = (fill(F.col("branch_name"), default_label) if default_label is not None
              else label_or_code(F.collate("branch_name", "UTF8_BINARY"), F.col("_spelt")))
    # The codes are those of the facts, not of the dimension: a distributed sort.
    return (g.select(bucket.alias("bucket"), bucket_rank(F.col("service_line")).alias("bucket_sort"),
                     F.col("_spelt").alias("branch_code"), *consts, *names)
            .orderBy("bucket_sort", "branch_code"))
