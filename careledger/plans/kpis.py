"""The 30 KPI result sets.

Each report is ``(Catalog, RunParams) -> DataFrame``; nothing runs until the
caller acts on the result.  Shapes at scale:

* dimension joins are broadcasts of bounded tables (``branching``);
* facts are filtered on the run window before any join, and the window
  predicates are written so parquet receives them as pushed filters;
* one-to-many sides are aggregated per episode before they meet the
  episode rows (K02, K15, K16, K19), so no join emits all pairs of a group
  and a hot episode never sits whole in one join task;
* the census counts steps up and down by day (K05) instead of a row for each
  stay and day, or a nested-loop range join;
* date windows name their partitions (``within``, ``open_or_closed_after``),
  which prunes files on the clustered layout and changes nothing elsewhere;
* hot groups (one bucket may hold a third of all rows) are only ever
  reduced by partial (map-side) aggregation, never collected.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.functions.columns import (
    aging_sums, as_flag, avg_dec, bucket_rank, days_between, fill, flag_in, hour_boundaries, lit_date,
    ratio_pct, clip_end, clip_start, zero_floor,
)
from careledger.functions.predicates import (
    active_on, claimable, in_window_by_date, in_window_half_open, in_window_raw, on_hold,
    differs, open_period, overlaps_window, overlaps_window_by_date, same, ts,
)
from careledger.operators.branching import (
    CODE_TABLE_MAX_ROWS, UNMAPPED, bounded_broadcast, by_branch_code, by_bucket, order_bounded,
    window_cols, with_bucket,
)
from careledger.operators.census import daily_census, daily_census_rows
from careledger.operators.ranges import count_in_ranges
from careledger.params import (
    BP1_HOURS, BP1_TARGET_PCT, FAST_ADMIT_DAYS, MEDIAN_LOS_BENCHMARK, RunParams,
)
from careledger.sources.catalog import Catalog
from careledger.sources.clustered import open_or_closed_after, within
from careledger.sources.collation import one_spelling, preselect
from careledger.sources.distinct_days import DistinctDays, census_by_stored_days
from careledger.sources.dims import HOME_HEALTH, HOSPICE, LUPA_CODES

C = F.col


def _one():
    """``1.0`` as DECIMAL(2,1), as in ``x * 1.0`` of the scripts (not a double)."""
    return F.lit(Decimal("1.0"))


# BP1 status texts.
BP1_MEETS = "✅ Meets KPI (>=80%)"
BP1_BELOW = "❌ Below KPI"


def _not_deleted_admitted(e: DataFrame) -> DataFrame:
    return e.filter(differs(C("epi_status"), "DELETED") & C("epi_NonAdmitDate").isNull())


def _new_admissions(e: DataFrame) -> DataFrame:
    e = preselect(e, epi_status="CURRENT", epi_AdmitType="NEW ADMISSION")
    return e.filter(same(C("epi_status"), "CURRENT") & C("epi_NonAdmitDate").isNull()
                    & same(C("epi_AdmitType"), "NEW ADMISSION"))


def only_of(history: DataFrame, key: str, rows: DataFrame, row_key: str) -> DataFrame:
    """The rows of a history table whose key occurs among the window's ``rows``.

    A semi-join below the aggregate or the wide join: the window's few keys
    (broadcast by the planner when they are small) reduce the history before
    it is grouped or shuffled."""
    return history.join(rows.select(C(row_key).alias("_wanted")), C("_wanted") == C(key), "left_semi")


# --------------------------------------------------------------------- admissions
def k01_admissions_by_branch(cat: Catalog, p: RunParams) -> DataFrame:
    e = _new_admissions(cat.episodes).filter(in_window_by_date(C("epi_SocDate"), p.start, p.end))
    e = with_bucket(e, cat.dim_branch, wildcard=True)
    g = e.groupBy("bucket").agg(F.min("bucket_sort").alias("service_line_id"),
                                F.count(F.lit(1)).alias("admission_count"))
    return (g.select(fill(C("bucket"), UNMAPPED).alias("service_line"), "service_line_id",
                     *window_cols(p.start, p.end), "admission_count")
            .transform(lambda d: order_bounded(d, "service_line", "service_line_id")))


def k02_admissions_by_care_type(cat: Catalog, p: RunParams) -> DataFrame:
    e = _new_admissions(cat.episodes).filter(in_window_by_date(C("epi_SocDate"), p.start, p.end))
    lines = bounded_broadcast(cat.service_lines, CODE_TABLE_MAX_ROWS, cat.service_lines.select(C("sl_id")))
    e = e.join(lines, lines["sl_id"] == e["epi_slid"], "inner").drop("sl_id")
    e = (with_bucket(e, cat.dim_branch, wildcard=True, hospice_rank=False, keep_service_line=True)
         .filter(C("_dim_service_line") == HOME_HEALTH))
    # One-to-many: an episode counts once per primary care-type row.  The
    # rows are first counted per (episode, type) (map-side, so a hot episode
    # never lands whole in one join task) and carried as a weight.
    types_of = preselect(cat.episode_care_types, cect_primary="Y").filter(same(C("cect_primary"), "Y"))
    primary = (only_of(types_of, "cect_epiid", e, "epi_id")
               .groupBy("cect_epiid", "cect_ctypeid").agg(F.count(F.lit(1)).alias("_w")))
    types = bounded_broadcast(cat.care_types, CODE_TABLE_MAX_ROWS,
                              cat.care_types.select("ctype_id", "ctype_description"))
    j = (e.join(primary, primary["cect_epiid"] == e["epi_id"], "left")
         .join(types, types["ctype_id"] == C("cect_ctypeid"), "left"))
    care_type = fill(C("ctype_description"), "(no primary care type)")
    g = j.groupBy(C("bucket"), care_type.alias("care_type")).agg(
        F.min("bucket_sort").alias("service_line_id"),
        F.sum(F.coalesce(C("_w"), F.lit(1))).alias("admission_count"))
    return (g.select(C("bucket").alias("service_line"), "service_line_id", "care_type",
                     *window_cols(p.start, p.end), "admission_count")
            .orderBy("care_type"))


def k03_days_to_admit(cat: Catalog, p: RunParams) -> DataFrame:
    e = _new_admissions(cat.episodes).filter(
        C("epi_DateOfReferral").isNotNull() & C("epi_SocDate").isNotNull()
        & in_window_by_date(C("epi_SocDate"), p.start, p.end))
    e = with_bucket(e, cat.dim_branch)
    m = (e.filter(F.to_date("epi_SocDate") >= F.to_date("epi_DateOfReferral"))
         .withColumn("days_to_admit", days_between("epi_DateOfReferral", "epi_SocDate")))
    g = m.groupBy("bucket").agg(
        F.min("bucket_sort").alias("service_line"),
        F.count(F.lit(1)).alias("admissions"),
        avg_dec(C("days_to_admit"), "decimal(10,2)").alias("avg_days_to_admit"),
        ratio_pct(F.sum(as_flag(C("days_to_admit") <= FAST_ADMIT_DAYS)), F.count(F.lit(1)),
                  "decimal(5,2)").alias("pct_within_2_days"),
    )
    return (g.select(fill(C("bucket"), UNMAPPED).alias("branch"), "service_line",
                     *window_cols(p.start, p.end), "admissions", "avg_days_to_admit",
                     "pct_within_2_days")
            .transform(lambda d: order_bounded(d, "service_line", "branch")))


# ------------------------------------------------------------------------ billing
def _lines_with_branch(cat: Catalog, lines: DataFrame, with_invoice: bool, windowed: bool = False) -> DataFrame:
    """Branch code from the invoice, else from the episode (two left joins).

    ``windowed`` lines are few: their keys reduce both histories first."""
    epi, inv = cat.episodes.select(C("epi_id"), C("epi_branchcode")), cat.invoices.select("i_id", "i_branchcode", "i_status")
    if windowed:
        epi, inv = only_of(epi, "epi_id", lines, "li_epiid"), only_of(inv, "i_id", lines, "li_iid")
    out = lines
    if with_invoice:
        out = out.join(inv, inv["i_id"] == out["li_iid"], "left")
    out = out.join(epi, epi["epi_id"] == out["li_epiid"], "left")
    code = F.coalesce(C("i_branchcode"), C("epi_branchcode")) if with_invoice else C("epi_branchcode")
    return out.withColumn("branch_code", code)


def k04_billing_holds_sla(cat: Catalog, p: RunParams) -> DataFrame:
    li = within(cat.line_items, "li_servicedate", p.start, p.end).filter(
        claimable() & in_window_by_date(C("li_servicedate"), p.start, p.end))
    bh = _lines_with_branch(cat, li, with_invoice=True, windowed=True).filter(
        on_hold(C("li_ediexportdate"), C("i_status")))
    cleared = as_flag(C("li_ediexportdate").isNotNull()
                      & (F.to_date("li_ediexportdate") <= lit_date(p.sla_cutoff)))
    bh = bh.withColumn("cleared_by_sla", cleared)
    aggs = [
        F.count(F.lit(1)).alias("total_holds"),
        F.sum("cleared_by_sla").alias("cleared_by_sla"),
        ratio_pct(F.sum("cleared_by_sla"), F.count(F.lit(1)), "decimal(5,1)").alias("pct_cleared_by_sla"),
        F.sum("li_calculatedamount").alias("total_hold_amount"),
        F.sum(F.when(C("cleared_by_sla") == 1, C("li_calculatedamount")).otherwise(F.lit(0)))
        .alias("cleared_amount"),
    ]
    consts = [*window_cols(p.start, p.end), lit_date(p.sla_cutoff).alias("sla_cutoff_date")]
    return by_branch_code(bh, cat.dim_branch, aggs, consts)


def k26_revenue_by_branch(cat: Catalog, p: RunParams) -> DataFrame:
    rev = _revenue_lines(cat, p)
    return by_bucket(rev, [F.sum("li_calculatedamount").cast("decimal(18,2)").alias("revenue")],
                     window_cols(p.start, p.end))


def _revenue_lines(cat: Catalog, p: RunParams) -> DataFrame:
    li = within(cat.line_items, "li_servicedate", p.start, p.end).filter(
        claimable() & in_window_raw(C("li_servicedate"), p.start, p.end))
    # The status test sits in ON, so a deleted episode leaves a NULL branch.
    epi = only_of(cat.episodes.filter(differs(C("epi_status"), "DELETED")).select("epi_id", "epi_branchcode"),
                  "epi_id", li, "li_epiid")
    j = li.join(epi, epi["epi_id"] == li["li_epiid"], "left")
    return with_bucket(j, cat.dim_branch, slid="li_slid", code="epi_branchcode")


def k27_revenue_per_patient_day(cat: Catalog, p: RunParams) -> DataFrame:
    rev = (_revenue_lines(cat, p).groupBy("bucket", "bucket_sort")
           .agg(F.sum("li_calculatedamount").alias("revenue")))
    days = (_patient_day_rows(cat, p).groupBy("bucket", "bucket_sort")
            .agg(F.sum(zero_floor(C("patient_days"))).alias("patient_days")))
    r, d = rev.alias("r"), days.alias("d")
    j = r.join(d, C("r.bucket") == C("d.bucket"), "full_outer")   # NULL never matches NULL
    revenue = F.coalesce(C("r.revenue"), F.lit(0))
    pdays = F.coalesce(C("d.patient_days"), F.lit(0))
    return (j.select(
        fill(F.coalesce(C("r.bucket"), C("d.bucket")), UNMAPPED).alias("bucket"),
        F.coalesce(C("r.bucket_sort"), C("d.bucket_sort")).alias("bucket_sort"),
        *window_cols(p.start, p.end),
        revenue.cast("decimal(18,2)").alias("revenue"),
        pdays.alias("patient_days"),
        F.when(pdays > 0, (revenue * _one() / C("d.patient_days")).cast("decimal(18,2)"))
        .alias("revenue_per_patient_day"))
        .transform(lambda d: order_bounded(d, "bucket_sort", "bucket")))


def _open_invoices(cat: Catalog, last: dt.date) -> DataFrame:
    """Invoices with a balance that may have been posted by ``last``."""
    return within(cat.invoices, "i_postdate", None, last).filter(C("i_balance") > 0).withColumnRenamed("i_branchcode", "branch_code")


def k28_ar_aging(cat: Catalog, p: RunParams) -> DataFrame:
    asof = lit_date(p.as_of)
    ar = (_open_invoices(cat, p.as_of)
          .filter(C("i_postdate").isNotNull() & (C("i_postdate") <= asof.cast("timestamp_ntz")))
          .withColumn("age_days", F.datediff(asof, C("i_postdate"))))
    return by_branch_code(ar, cat.dim_branch, aging_sums(C("age_days"), C("i_balance")),
                          window_cols(p.start, p.end))


def k29_ar_over_90(cat: Catalog, p: RunParams) -> DataFrame:
    # DATEDIFF(day, i_postdate, as_of) > 90, as a range on the raw column that the scan can use.
    last = p.as_of - dt.timedelta(days=90)
    ar = _open_invoices(cat, last).filter(C("i_postdate") < ts(last))
    aggs = [F.count(F.lit(1)).alias("invoices_over_90"), F.sum("i_balance").alias("ar_over_90")]
    return by_branch_code(ar, cat.dim_branch, aggs, window_cols(p.start, p.end), default_label=UNMAPPED)


def k30_unbilled(cat: Catalog, p: RunParams) -> DataFrame:
    li = cat.line_items.filter(claimable() & C("li_ediexportdate").isNull() & C("li_iid").isNull())
    # The script also left-joins invoices on i_id = li_iid, which can never
    # match while li_iid IS NULL: the branch always comes from the episode.
    u = _lines_with_branch(cat, li, with_invoice=False)
    aggs = [F.count(F.lit(1)).alias("unbilled_line_items"),
            F.sum(F.coalesce(C("li_calculatedamount"), F.lit(0))).alias("unbilled_amount")]
    return by_branch_code(u, cat.dim_branch, aggs, window_cols(p.start, p.end), default_label=UNMAPPED)


# ------------------------------------------------------------------------- census
def _census_stays(cat: Catalog, start: dt.date, end: dt.date) -> DataFrame:
    """Current stays that touch the days, with line and branch: (epi_SocDate, epi_DischargeDate, epi_paid, sl_desc, branch_name)."""
    e = preselect(open_or_closed_after(cat.episodes, "epi_DischargeDate", start), epi_status="CURRENT").filter(
        same(C("epi_status"), "CURRENT") & overlaps_window(C("epi_SocDate"), C("epi_DischargeDate"), start, end))
    lines = bounded_broadcast(cat.service_lines, CODE_TABLE_MAX_ROWS)
    branches = bounded_broadcast(cat.branches, CODE_TABLE_MAX_ROWS,
                                 cat.branches.select(F.rtrim("branch_code").alias("_b_code"), "branch_name"))
    return (e.join(lines, lines["sl_id"] == e["epi_slid"], "inner")
            .join(branches, branches["_b_code"] == F.rtrim(C("epi_branchcode")), "inner")
            .select("epi_SocDate", "epi_DischargeDate", "epi_paid", "sl_desc", "branch_name"))


def k05_daily_census(cat: Catalog, p: RunParams) -> DataFrame:
    return daily_census(_census_stays(cat, p.start, p.end), ["sl_desc", "branch_name"], "epi_paid", p.start, p.end)


def stored_daily_census(cat: Catalog, p: RunParams, store: DistinctDays) -> DataFrame:
    """K05 of a recurring run: days that earlier runs have stored are not counted again."""
    return census_by_stored_days(
        store, lambda day: daily_census_rows(_census_stays(cat, day, day), day, day).select("sl_desc", "branch_name", "epi_paid"),
        p.start, p.end, "epi_paid")


def _hce_census(cat: Catalog, p: RunParams) -> DataFrame:
    e = open_or_closed_after(cat.episodes, "epi_DischargeDate", p.as_of).filter(
        differs(C("epi_status"), "CURRENT") & C("epi_NonAdmitDate").isNull() & active_on(
            C("epi_SocDate"), C("epi_DischargeDate"), p.as_of))
    e = with_bucket(e, cat.dim_branch, keep_service_line=True)
    return (e.groupBy(C("_dim_service_line").alias("service_line"), C("bucket").alias("branch_name"))
            .agg(F.count(F.lit(1)).alias("current_census")))


def _hce_consts(p: RunParams):
    return [lit_date(p.as_of).alias("as_of_date"),
            F.lit(p.hce_factor).cast("decimal(5,3)").alias("hce_factor")]


def k09_hce_by_branch(cat: Catalog, p: RunParams) -> DataFrame:
    c = _hce_census(cat, p)
    factor = F.lit(p.hce_factor).cast("decimal(5,3)")
    value = F.when(C("service_line") == HOME_HEALTH, C("current_census") * factor).otherwise(C("current_census"))
    return c.select(C("branch_name").alias("bucket"), "service_line", *_hce_consts(p),
                    C("current_census").alias("raw_census"), value.cast("decimal(10,2)").alias("hce_value"))


def k10_hce_combined(cat: Catalog, p: RunParams) -> DataFrame:
    c = _hce_census(cat, p).filter(C("service_line") == HOME_HEALTH)
    factor = F.lit(p.hce_factor).cast("decimal(5,3)")
    g = c.agg(F.sum("current_census").alias("raw_hh_pal_census"))
    return g.select(F.lit("HH+Palliative").alias("bucket"), *_hce_consts(p), "raw_hh_pal_census",
                    (C("raw_hh_pal_census") * factor).cast("decimal(10,2)").alias("hce_value"))


def k11_hce_total(cat: Catalog, p: RunParams) -> DataFrame:
    c = _hce_census(cat, p)
    factor = F.lit(p.hce_factor).cast("decimal(5,3)")
    hh = F.sum(F.when(C("service_line") == HOME_HEALTH, C("current_census")).otherwise(F.lit(0)))
    hos = F.sum(F.when(C("service_line") == HOSPICE, C("current_census")).otherwise(F.lit(0)))
    g = c.agg(hh.alias("raw_hh_pal_census"), hos.alias("raw_hospice_census"))
    return g.select(F.lit("ALL LOCATIONS").alias("bucket"), *_hce_consts(p), "raw_hh_pal_census",
                    "raw_hospice_census",
                    (C("raw_hospice_census") + C("raw_hh_pal_census") * factor).cast("decimal(10,2)")
                    .alias("total_hce"))


# ------------------------------------------------------------------- discharges
def _discharges(cat: Catalog, p: RunParams, discharged: bool) -> DataFrame:
    status = same(C("epi_status"), "DISCHARGED") if discharged else differs(C("epi_status"), "DISCHARGED")
    e = within(cat.episodes, "epi_DischargeDate", p.start, p.end)
    e = (preselect(e, epi_status="DISCHARGED") if discharged else e).filter(
        status & in_window_half_open(C("epi_DischargeDate"), p.start, p.end))
    return with_bucket(e, cat.dim_branch)


def _with_dc_class(cat: Catalog, df: DataFrame) -> DataFrame:
    # A literal 9-row code map: its size is known at planning time.
    m = F.broadcast(cat.dc_class.select(F.rtrim("dr_code").alias("_dr_code"), C("dc_class").alias("_cls")))
    j = df.join(m, m["_dr_code"] == F.rtrim(C("epi_DcCode")), "left")
    return j.withColumn("dc_class", fill(C("_cls"), "Other")).drop("_dr_code", "_cls")


def k06_discharges_total(cat: Catalog, p: RunParams) -> DataFrame:
    return by_bucket(_discharges(cat, p, False), [F.count(F.lit(1)).alias("total_discharges")],
                     window_cols(p.start, p.end))


def k07_discharges_by_class(cat: Catalog, p: RunParams) -> DataFrame:
    d = _with_dc_class(cat, _discharges(cat, p, True))
    g = d.groupBy("bucket", "dc_class").agg(
        F.min("bucket_sort").alias("bucket_sort"), F.count(F.lit(1)).alias("discharges"),
        F.countDistinct(F.rtrim("epi_DcCode")).alias("distinct_dc_codes"))
    return (g.select(fill(C("bucket"), UNMAPPED).alias("bucket"), "bucket_sort", "dc_class",
                     "discharges", "distinct_dc_codes")
            .transform(lambda d: order_bounded(d, "bucket_sort", "dc_class")))


def k08_live_discharge_summary(cat: Catalog, p: RunParams) -> DataFrame:
    d = _with_dc_class(cat, _discharges(cat, p, False))
    cls = C("dc_class")
    live = ["LiveDC-PatientInitiated", "LiveDC-HospiceInitiated"]
    aggs = [
        F.sum(as_flag(cls == live[0])).alias("live_dc_patient_initiated"),
        F.sum(as_flag(cls == live[1])).alias("live_dc_hospice_initiated"),
        F.sum(as_flag(cls.isin(live))).alias("live_dc_total"),
        F.sum(as_flag(cls == "Death")).alias("deaths"),
        F.sum(as_flag(cls == "Other")).alias("other_or_unmapped"),
    ]
    return by_bucket(d, aggs, window_cols(p.start, p.end))


# ------------------------------------------------------------------ length of stay
def k12_los_discharged(cat: Catalog, p: RunParams) -> DataFrame:
    e = _not_deleted_admitted(within(cat.episodes, "epi_DischargeDate", p.start, p.end)).filter(
        C("epi_DischargeDate").isNotNull() & in_window_by_date(C("epi_DischargeDate"), p.start, p.end))
    e = with_bucket(e, cat.dim_branch).withColumn(
        "los_days", days_between("epi_SocDate", "epi_DischargeDate"))
    aggs = [
        F.count(F.lit(1)).alias("discharged_episodes"),
        avg_dec(C("los_days"), "decimal(10,1)").alias("avg_los_days"),
        # Exact interpolated median; its state is a value -> count map,
        # bounded by the distinct day counts, so a hot bucket stays small.
        F.percentile(C("los_days"), 0.5).cast("decimal(10,1)").alias("median_los_days"),
    ]
    out = by_bucket(e, aggs, window_cols(p.start, p.end), order=None)
    return (out.withColumn("median_los_benchmark", F.lit(MEDIAN_LOS_BENCHMARK))
            .transform(lambda d: order_bounded(d, "bucket_sort", "bucket")))


def k13_los_active(cat: Catalog, p: RunParams) -> DataFrame:
    e = _not_deleted_admitted(open_or_closed_after(cat.episodes, "epi_DischargeDate", p.as_of)).filter(
        active_on(C("epi_SocDate"), C("epi_DischargeDate"), p.as_of))
    e = with_bucket(e, cat.dim_branch).withColumn(
        "los_days", days_between("epi_SocDate", lit_date(p.as_of)))
    aggs = [F.count(F.lit(1)).alias("active_census"),
            avg_dec(C("los_days"), "decimal(10,1)").alias("avg_current_los_days")]
    return by_bucket(e, aggs, [lit_date(p.as_of).alias("as_of_date")], order="bucket")


# --------------------------------------------------------------------------- LUPA
def _window_periods(cat: Catalog, p: RunParams) -> DataFrame:
    """Periods ended, not deleted, with the end date in the window (P8 on a DATE)."""
    return within(cat.pdgm_period, "pp_endDate", p.start, p.end).filter(
        open_period() & C("pp_endDate").between(lit_date(p.start), lit_date(p.end)))


def _ended_periods(cat: Catalog, p: RunParams) -> DataFrame:
    """The window's periods with their episodes."""
    pp = _window_periods(cat, p)
    fs = cat.episode_fs.select("cefs_id", "cefs_epiid")
    return pp.join(fs, fs["cefs_id"] == pp["pp_cefsId"], "inner")


def _periods_with_bucket(cat: Catalog, periods: DataFrame) -> DataFrame:
    e = only_of(cat.episodes.filter(differs(C("epi_status"), "DELETED")).select("epi_id", "epi_slid", "epi_branchcode"),
                "epi_id", periods, "cefs_epiid")
    j = periods.join(e, e["epi_id"] == periods["cefs_epiid"], "inner")
    return with_bucket(j, cat.dim_branch)


def _lupa_aggs():
    return [F.sum("is_lupa").alias("lupa_periods"), F.count(F.lit(1)).alias("total_periods"),
            ratio_pct(F.sum("is_lupa"), F.count(F.lit(1)), "decimal(6,2)", guard="zero").alias("lupa_pct")]


def k14_lupa_by_reimbursement(cat: Catalog, p: RunParams) -> DataFrame:
    per = _periods_with_bucket(cat, _ended_periods(cat, p)).withColumn(
        "is_lupa", as_flag(F.trim(C("pp_reimbursementType")).isin(LUPA_CODES)))
    return by_bucket(per, _lupa_aggs(), window_cols(p.start, p.end))


def period_visit_counts(cat: Catalog, periods: DataFrame, end: dt.date, with_zero: bool = True,
                        starts: DataFrame | None = None) -> DataFrame:
    """J8 + J9: billable, undeleted visits of the episode inside each period (none ends after ``end``).

    The visit scan gets both bounds of the periods (``end`` as a literal, the
    least start as a scalar subquery) and only visits of the periods' episodes
    are shuffled, counted by episode and day.  Periods and days then meet by
    episode and time bin (``count_in_ranges``), so an episode with many visits is
    spread over its bins.  ``with_zero`` attaches the periods without visits
    (count 0); a caller that left-joins the counts itself skips that join.
    ``starts`` are rows that begin no later than the periods and cost less to read."""
    least = (periods if starts is None else starts).agg(F.min("pp_startDate").cast("timestamp_ntz").alias("least")).scalar()
    v = within(cat.visits_all, "cev_visitdate", None, end).filter(
        (C("cev_deleted") == 0) & (C("cev_billable") == 1)
        & (C("cev_visitdate") < ts(end + dt.timedelta(days=1))) & (C("cev_visitdate") >= least))
    v = only_of(v, "cev_epiid", periods, "cefs_epiid").where(C("cev_id").isNotNull())
    counts = count_in_ranges(
        v.select(C("cev_epiid").alias("key"), F.to_date("cev_visitdate").alias("day")),
        periods.select(C("pp_id").alias("id"), C("cefs_epiid").alias("key"), C("pp_startDate").alias("first"),
                       C("pp_endDate").alias("last"))).select(C("id").alias("pp_id"), C("n").alias("visit_count"))
    if not with_zero:
        return counts
    return (periods.select("pp_id").join(counts, "pp_id", "left")
            .select("pp_id", F.coalesce(C("visit_count"), F.lit(0)).alias("visit_count")))


def k15_lupa_by_threshold(cat: Catalog, p: RunParams) -> DataFrame:
    periods = _ended_periods(cat, p)
    counts = period_visit_counts(cat, periods, p.end, with_zero=False,
                                 starts=_window_periods(cat, p)).withColumnRenamed("pp_id", "_pv_id")
    hipps = bounded_broadcast(cat.pdgm_hipps, CODE_TABLE_MAX_ROWS,
                              cat.pdgm_hipps.select(F.rtrim("ph_hipps").alias("ph_hipps"), "ph_lupaThreshold"))
    per = (_periods_with_bucket(cat, periods)
           .join(counts, C("_pv_id") == C("pp_id"), "left")
           .withColumn("visit_count", F.coalesce(C("visit_count"), F.lit(0)))
           .join(hipps, hipps["ph_hipps"] == F.trim(C("pp_currentHipps")), "left"))
    per = per.withColumn("is_lupa", as_flag(C("ph_lupaThreshold").isNotNull()
                                            & (C("visit_count") < C("ph_lupaThreshold"))))
    return by_bucket(per, _lupa_aggs(), window_cols(p.start, p.end))


# ---------------------------------------------------------------------------- BP1
def _bp1_rows(cat: Catalog, p: RunParams) -> DataFrame:
    adm = _not_deleted_admitted(cat.episodes).filter(
        in_window_by_date(C("epi_SocDate"), p.start, p.end)).select("epi_id", "epi_SocDate")
    marked = preselect(cat.visits, cev_setsocdateflag="Y").filter(same(C("cev_setsocdateflag"), "Y"))
    first = (only_of(marked, "cev_epiid", adm, "epi_id")
             .groupBy("cev_epiid").agg(F.min("cev_visitdate").alias("bp1_date")))
    j = adm.join(first, first["cev_epiid"] == adm["epi_id"], "left")
    return j.withColumn("hours_to_bp1", hour_boundaries("epi_SocDate", "bp1_date"))


def k16_bp1_summary(cat: Catalog, p: RunParams) -> DataFrame:
    r = _bp1_rows(cat, p).withColumn(
        "bp1_within_48hrs", as_flag(C("bp1_date").isNotNull() & (C("hours_to_bp1") <= BP1_HOURS)))
    g = r.agg(F.count(F.lit(1)).alias("total_admissions"),
              F.sum("bp1_within_48hrs").alias("bp1_compliant"))
    share = F.lit(100.0).cast("decimal(4,1)") * C("bp1_compliant") / F.nullif(C("total_admissions"), F.lit(0))
    return g.select(
        "total_admissions", "bp1_compliant",
        F.round(share, 2).cast("decimal(10,2)").alias("bp1_compliance_percent"),
        F.when(share >= BP1_TARGET_PCT, BP1_MEETS).otherwise(BP1_BELOW).alias("kpi_status"))


def k17_bp1_detail(cat: Catalog, p: RunParams) -> DataFrame:
    r = _bp1_rows(cat, p)
    status = (F.when(C("bp1_date").isNull(), "No BP1")
              .when(C("hours_to_bp1") <= BP1_HOURS, "Compliant").otherwise("Late"))
    # ORDER BY epi_SocDate; epi_id breaks ties (unordered in the script) so a
    # hot start time still splits across range partitions.
    return (r.select("epi_id", "epi_SocDate", "bp1_date", "hours_to_bp1", status.alias("bp1_status"))
            .orderBy("epi_SocDate", "epi_id"))


# -------------------------------------------------------------------- patient days
def _patient_day_rows(cat: Catalog, p: RunParams) -> DataFrame:
    e = _not_deleted_admitted(open_or_closed_after(cat.episodes, "epi_DischargeDate", p.start)).filter(
        overlaps_window(C("epi_SocDate"), C("epi_DischargeDate"), p.start, p.end))
    e = with_bucket(e, cat.dim_branch)
    return e.withColumn("patient_days", days_between(clip_start(C("epi_SocDate"), p.start),
                                                     clip_end(C("epi_DischargeDate"), p.end)))


def k18_patient_days(cat: Catalog, p: RunParams) -> DataFrame:
    days = p.days_in_window
    total = F.sum(zero_floor(C("patient_days")))
    aggs = [total.alias("patient_days"),
            (total * _one() / F.lit(days)).cast("decimal(10,2)").alias("implied_adc")]
    out = by_bucket(_patient_day_rows(cat, p), aggs, window_cols(p.start, p.end), order=None)
    return (out.select("bucket", "bucket_sort", "window_start", "window_end", "patient_days",
                       F.lit(days).alias("days_in_window"), "implied_adc")
            .transform(lambda d: order_bounded(d, "bucket_sort", "bucket")))


# ---------------------------------------------------------------------- QA / recert
def k19_qa_compliance(cat: Catalog, p: RunParams) -> DataFrame:
    """Three one-to-many left joins, counted without building their product.

    Each side is first reduced to counts per episode (partial aggregation
    before the shuffle); the joined-row counts of the script then follow by
    multiplication: an episode with f face-to-face rows (a of them active),
    c certification rows and r recert rows stands for max(f,1)*max(c,1)*max(r,1)
    joined rows."""
    e = _not_deleted_admitted(cat.episodes).filter(in_window_by_date(C("epi_SocDate"), p.start, p.end))
    e = with_bucket(e.select("epi_id", "epi_slid", "epi_branchcode", "epi_RecertFlag"), cat.dim_branch)
    f2f = only_of(cat.facetoface, "ceftf_f2fappliestoepiid", e, "epi_id").groupBy(C("ceftf_f2fappliestoepiid").alias("_f_id")).agg(
        F.count(F.lit(1)).alias("_nf"), F.sum(as_flag(C("ceftf_active") == 1)).alias("_nfa"))
    cert = only_of(cat.admission_types, "ceat_epiid", e, "epi_id").groupBy(C("ceat_epiid").alias("_c_id")).agg(F.count(F.lit(1)).alias("_nc"))
    rec = only_of(cat.recert_history, "cerh_epiid", e, "epi_id").groupBy(C("cerh_epiid").alias("_r_id")).agg(F.count(F.lit(1)).alias("_nr"))
    j = (e.join(f2f, C("_f_id") == C("epi_id"), "left")
         .join(cert, C("_c_id") == C("epi_id"), "left")
         .join(rec, C("_r_id") == C("epi_id"), "left"))
    nf, nfa = F.coalesce(C("_nf"), F.lit(0)), F.coalesce(C("_nfa"), F.lit(0))
    nc, nr = F.coalesce(C("_nc"), F.lit(0)), F.coalesce(C("_nr"), F.lit(0))
    one = F.lit(1)
    wf, wc, wr = F.greatest(nf, one), F.greatest(nc, one), F.greatest(nr, one)
    wants = flag_in(C("epi_RecertFlag"), null_as_blank=True)
    rows = wf * wc * wr
    j = j.select(
        "bucket", "bucket_sort",
        rows.alias("rows"),
        (nfa * wc * wr).alias("f2f"),
        (nc * wf * wr).alias("cert"),
        F.when(wants & (nr == 0), F.lit(0)).otherwise(rows).alias("recert"),
        (nfa * nc * F.when(wants, nr).otherwise(wr)).alias("full"),
    )
    aggs = [
        F.sum("rows").alias("total_episodes"),
        F.sum("f2f").alias("f2f_compliant"),
        F.sum("cert").alias("cert_compliant"),
        F.sum("recert").alias("recert_compliant"),
        F.sum("full").alias("compliant_episodes"),
        ratio_pct(F.sum("full"), F.sum("rows"), "decimal(5,1)").alias("qa_compliance_pct"),
    ]
    return by_bucket(j, aggs, window_cols(p.start, p.end), label=False)


def k20_recert_rate(cat: Catalog, p: RunParams) -> DataFrame:
    e = cat.episodes.filter(differs(C("epi_status"), "RECERTIFIED") & C("epi_NonAdmitDate").isNull()
                            & in_window_by_date(C("epi_SocDate"), p.start, p.end))
    e = with_bucket(e, cat.dim_branch).withColumn("is_recert", as_flag(flag_in(C("epi_RecertFlag"))))
    aggs = [F.sum("is_recert").alias("recert_count"), F.count(F.lit(1)).alias("total_cert_count"),
            ratio_pct(F.sum("is_recert"), F.count(F.lit(1)), "decimal(5,1)", guard="positive")
            .alias("recert_pct")]
    return by_bucket(e, aggs, window_cols(p.start, p.end))


def k21_recert_share_of_episodes(cat: Catalog, p: RunParams) -> DataFrame:
    e = open_or_closed_after(cat.episodes, "epi_DischargeDate", p.start).filter(
        differs(C("epi_status"), "RECERTIFIED") & C("epi_NonAdmitDate").isNull()
        & overlaps_window_by_date(C("epi_SocDate"), C("epi_DischargeDate"), p.start, p.end))
    flag = as_flag(flag_in(C("epi_RecertFlag")) & in_window_by_date(C("epi_SocDate"), p.start, p.end))
    e = with_bucket(e, cat.dim_branch).withColumn("is_recert_in_window", flag)
    aggs = [F.sum("is_recert_in_window").alias("recert_count"),
            F.count(F.lit(1)).alias("total_episode_count"),
            ratio_pct(F.sum("is_recert_in_window"), F.count(F.lit(1)), "decimal(5,1)", guard="positive")
            .alias("recert_pct_of_episodes")]
    return by_bucket(e, aggs, window_cols(p.start, p.end))


# ------------------------------------------------------------------ referrals / NTUC
def _referral_conversion(cat: Catalog, p: RunParams, strict: bool) -> DataFrame:
    e = cat.episodes.filter(differs(C("epi_status"), "DELETED"))
    is_ref = in_window_by_date(C("epi_DateOfReferral"), p.start, p.end)
    is_adm = in_window_by_date(C("epi_SocDate"), p.start, p.end) & C("epi_NonAdmitDate").isNull()
    is_na = C("epi_NonAdmitDate").isNotNull() & in_window_by_date(C("epi_NonAdmitDate"), p.start, p.end)
    e = e.filter(is_ref | is_adm | is_na)   # P12, pushed to the scan as one OR filter
    dim = cat.dim_branch_17 if strict else cat.dim_branch
    e = with_bucket(e, dim, wildcard=not strict).select(
        "bucket", "bucket_sort", as_flag(is_ref).alias("is_referral"),
        as_flag(is_adm).alias("is_admission"), as_flag(is_na).alias("is_nonadmit"))
    refs = F.sum("is_referral")
    aggs = [refs.alias("referrals"), F.sum("is_admission").alias("admissions"),
            F.sum("is_nonadmit").alias("non_admits"),
            ratio_pct(F.sum("is_nonadmit"), refs, "decimal(5,1)", guard="positive").alias("ntuc_pct"),
            ratio_pct(F.sum("is_admission"), refs, "decimal(5,1)", guard="positive").alias("conversion_pct")]
    return by_bucket(e, aggs, window_cols(p.start, p.end))


def k22_referral_conversion_strict(cat: Catalog, p: RunParams) -> DataFrame:
    return _referral_conversion(cat, p, strict=True)


def k24_referral_conversion(cat: Catalog, p: RunParams) -> DataFrame:
    return _referral_conversion(cat, p, strict=False)


def dedup_reasons(reasons: DataFrame) -> DataFrame:
    """One row per reason code (codes compare without trailing blanks): smallest text, any refusal flag."""
    return reasons.groupBy(F.rtrim("nac_code").alias("nac_code")).agg(
        F.min("nac_desc").alias("nac_desc"),
        F.bool_or("nac_refusalofservice").alias("nac_refusalofservice"))


def _nonadmit_reasons(cat: Catalog, p: RunParams, dedup: bool) -> DataFrame:
    e = cat.episodes.filter(differs(C("epi_status"), "DELETED") & C("epi_NonAdmitDate").isNotNull()
                            & in_window_by_date(C("epi_NonAdmitDate"), p.start, p.end))
    e = e.withColumn("epi_NonAdmitCode", F.rtrim("epi_NonAdmitCode"))
    e = with_bucket(e, cat.dim_branch_17 if dedup else cat.dim_branch, wildcard=not dedup)
    reasons = dedup_reasons(cat.nonadmit_reasons) if dedup else cat.nonadmit_reasons
    r = bounded_broadcast(cat.nonadmit_reasons, CODE_TABLE_MAX_ROWS,
                          reasons.select(F.rtrim("nac_code").alias("nac_code"), "nac_desc", "nac_refusalofservice"))
    j = e.join(r, r["nac_code"] == e["epi_NonAdmitCode"], "left")
    g = j.groupBy("bucket", "epi_NonAdmitCode", "nac_desc", "nac_refusalofservice").agg(
        F.min("bucket_sort").alias("bucket_sort"), F.count(F.lit(1)).alias("non_admit_count"),
        one_spelling("epi_NonAdmitCode").alias("nonadmit_code"))
    return (g.select(fill(C("bucket"), UNMAPPED).alias("bucket"), "bucket_sort",
                     *window_cols(p.start, p.end), "nonadmit_code",
                     fill(C("nac_desc"), "(unknown reason)").alias("nonadmit_reason"),
                     C("nac_refusalofservice").alias("refusal_of_service"), "non_admit_count")
            .orderBy(C("bucket_sort"), C("non_admit_count").desc()))


def k23_nonadmit_reasons_dedup(cat: Catalog, p: RunParams) -> DataFrame:
    return _nonadmit_reasons(cat, p, dedup=True)


def k25_nonadmit_reasons_raw(cat: Catalog, p: RunParams) -> DataFrame:
    return _nonadmit_reasons(cat, p, dedup=False)


# Registry: query name -> (report function, which parameter set).
KPI_REPORTS = {
    "k01_admissions_by_branch": k01_admissions_by_branch,
    "k02_admissions_by_care_type": k02_admissions_by_care_type,
    "k03_days_to_admit": k03_days_to_admit,
    "k04_billing_holds_sla": k04_billing_holds_sla,
    "k05_daily_census": k05_daily_census,
    "k06_discharges_total": k06_discharges_total,
    "k07_discharges_by_class": k07_discharges_by_class,
    "k08_live_discharge_summary": k08_live_discharge_summary,
    "k09_hce_by_branch": k09_hce_by_branch,
    "k10_hce_combined": k10_hce_combined,
    "k11_hce_total": k11_hce_total,
    "k12_los_discharged": k12_los_discharged,
    "k13_los_active": k13_los_active,
    "k14_lupa_by_reimbursement": k14_lupa_by_reimbursement,
    "k15_lupa_by_threshold": k15_lupa_by_threshold,
    "k16_bp1_summary": k16_bp1_summary,
    "k17_bp1_detail": k17_bp1_detail,
    "k18_patient_days": k18_patient_days,
    "k19_qa_compliance": k19_qa_compliance,
    "k20_recert_rate": k20_recert_rate,
    "k21_recert_share_of_episodes": k21_recert_share_of_episodes,
    "k22_referral_conversion_strict": k22_referral_conversion_strict,
    "k23_nonadmit_reasons_dedup": k23_nonadmit_reasons_dedup,
    "k24_referral_conversion": k24_referral_conversion,
    "k25_nonadmit_reasons_raw": k25_nonadmit_reasons_raw,
    "k26_revenue_by_branch": k26_revenue_by_branch,
    "k27_revenue_per_patient_day": k27_revenue_per_patient_day,
    "k28_ar_aging": k28_ar_aging,
    "k29_ar_over_90": k29_ar_over_90,
    "k30_unbilled": k30_unbilled,
}

# Reports run with the wider 90-day window in tests (thin at fixture scale).
WIDE_WINDOW = {"k02_admissions_by_care_type"}
