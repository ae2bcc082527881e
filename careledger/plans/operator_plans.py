"""One runnable plan per operator of the inventory (S, P, J, A, W, O, U, F, R, T).

Each entry runs the operator's shape over the bound fixture tables (whole
tables, never a subset) and reduces the result to a compact, checkable
frame; each has an oracle written in DuckDB SQL against the same binding.
The operator itself is the library helper the reports use, so these plans
double as regression checks of the helpers on full data.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from careledger.functions.columns import (
    aging_sums, as_flag, avg_dec, bucket_rank, blank_to_null, clip_end, clip_start, days_between, fill, flag_in,
    hour_boundaries, label_or_code, lit_date, ratio_pct, zero_floor,
)
from careledger.functions.predicates import (
    active_on, claimable, in_window_by_date, in_window_half_open, in_window_raw, on_hold, open_period,
    differs, overlaps_window, overlaps_window_by_date, same,
)
from careledger.operators.branching import (
    CODE_TABLE_MAX_ROWS, UNMAPPED, bounded_broadcast, with_branch_by_code, with_bucket,
)
from careledger.operators.census import daily_census_rows, date_spine
from careledger.operators import scripts as T
from careledger.params import HCE_FACTOR, RunParams, run_days, test_params
from careledger.plans import kpis
from careledger.plans.oracle_kpis import kpi_oracle_sql
from careledger.plans.oracle_tables import with_tables
from careledger.sources.catalog import Catalog
from careledger.sources.dims import DC_CLASS_ROWS, LUPA_CODES
from careledger.sources.driver_tables import bind_driver_tables

C = F.col
N = lambda: F.count(F.lit(1))
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
FIXTURE_SQL_DIR = os.path.join(REPO, "tests", "fixtures", "sql")
FUTURE = RunParams.build(as_of=dt.date(2035, 1, 15))   # a window with no data at all

_SPARK: dict[str, Callable[[Catalog, RunParams], DataFrame]] = {}
_SQL: dict[str, tuple[str, list[str]]] = {}
_RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def op(name: str, sql: str | None = None, tables: list[str] | None = None):
    def deco(fn):
        _SPARK[name] = fn
        if sql is not None:
            _SQL[name] = (sql, tables or [])
        return fn
    return deco


# ============================================================ S: scans, sources
@op("s1_base_table_scan", """
SELECT epi_status, epi_AdmitType, COUNT(*) AS episodes FROM episodes GROUP BY epi_status, epi_AdmitType
""", ["episodes"])
def _s1(cat, p):
    return cat.episodes.groupBy("epi_status", "epi_AdmitType").agg(N().alias("episodes"))


@op("s2_inline_branch_dim", """
SELECT 16 AS variant, * FROM dim_branch UNION ALL SELECT 17 AS variant, * FROM dim_branch_17
""", ["dim_branch", "dim_branch_17"])
def _s2(cat, p):
    return (cat.dim_branch.select(F.lit(16).alias("variant"), "*")
            .unionByName(cat.dim_branch_17.select(F.lit(17).alias("variant"), "*")))


@op("s3_inline_code_maps", """
SELECT rtrim(e.epi_DcCode) AS dc_code, coalesce(c.dc_class, 'Other') AS dc_class, COUNT(*) AS episodes
FROM episodes e LEFT JOIN dc_class c ON rtrim(c.dr_code) = rtrim(e.epi_DcCode)
GROUP BY rtrim(e.epi_DcCode), coalesce(c.dc_class, 'Other')
UNION ALL
SELECT trim(pp_reimbursementType), CASE WHEN l.code IS NULL THEN 'not LUPA' ELSE 'LUPA' END, COUNT(*)
FROM pdgm_period pp LEFT JOIN lupa_codes l ON l.code = trim(pp.pp_reimbursementType)
GROUP BY 1, 2
""", ["episodes", "dc_class", "pdgm_period", "lupa_codes"])
def _s3(cat, p):
    m = F.broadcast(cat.dc_class)          # literal 9-row map
    e = cat.episodes.join(m, F.rtrim(m["dr_code"]) == F.rtrim(C("epi_DcCode")), "left")
    a = e.groupBy(F.rtrim("epi_DcCode").alias("dc_code"), fill(C("dc_class"), "Other").alias("dc_class")) \
        .agg(N().alias("episodes"))
    lc = F.broadcast(cat.lupa_codes)       # literal 2-row map
    pp = cat.pdgm_period.join(lc, lc["code"] == F.trim("pp_reimbursementType"), "left")
    b = pp.groupBy(F.trim("pp_reimbursementType").alias("dc_code"),
                   F.when(C("code").isNull(), "not LUPA").otherwise("LUPA").alias("dc_class")) \
        .agg(N().alias("episodes"))
    return a.unionByName(b)


@op("s4_date_spine", """
WITH RECURSIVE dates(d) AS (SELECT {S} UNION ALL SELECT CAST(d + 1 AS DATE) FROM dates WHERE d < {E})
SELECT d AS CensusDate, COUNT(e.epi_id) AS admissions
FROM dates LEFT JOIN episodes e ON CAST(e.epi_SocDate AS DATE) = d
GROUP BY d
""", ["episodes"])
def _s4(cat, p):
    spine = date_spine(cat.spark, p.start, p.end)   # days_in_window rows
    # Count per day first (map-side), so a hot day never sits whole in one join task.
    per_day = cat.episodes.filter(in_window_by_date(C("epi_SocDate"), p.start, p.end)) \
        .groupBy(F.to_date("epi_SocDate").alias("_d")).agg(F.count("epi_id").alias("_n"))
    # per_day holds at most days_in_window rows (grouped by a date inside the window).
    return spine.join(F.broadcast(per_day), C("_d") == C("CensusDate"), "left") \
        .select("CensusDate", F.coalesce(C("_n"), F.lit(0)).alias("admissions"))


@op("s6_definition_file_scan", """
SELECT 'Branch ' || rtrim(epi_branchcode) AS name, 0 AS query_no,
       'SELECT COUNT(*) AS n FROM episodes WHERE rtrim(epi_branchcode) = ''' || rtrim(epi_branchcode) || '''' AS query
FROM dim_branch
UNION ALL
SELECT 'Branch ' || rtrim(epi_branchcode), 1,
       'SELECT COUNT(*) AS n FROM invoices WHERE rtrim(i_branchcode) = ''' || rtrim(epi_branchcode) || ''''
FROM dim_branch WHERE epi_slid = 1
""", ["dim_branch"])
def _s6(cat, p):
    from careledger.sources.scripts import definitions_file
    from careledger.session import ensure_checkpoint_dir
    code = F.rtrim("epi_branchcode")
    q0 = F.concat(F.lit("SELECT COUNT(*) AS n FROM episodes WHERE rtrim(epi_branchcode) = '"), code, F.lit("'"))
    q1 = F.concat(F.lit("SELECT COUNT(*) AS n FROM invoices WHERE rtrim(i_branchcode) = '"), code, F.lit("'"))
    # Home-health branches get two queries (an array), hospice ones a single string.
    entry = F.when(C("epi_slid") == 1,
                   F.to_json(F.struct(C("name"), F.array(q0, q1).alias("query"), F.lit("generated").alias("sourceFile"))))\
        .otherwise(F.to_json(F.struct(C("name"), q0.alias("query"), F.lit("generated").alias("sourceFile"))))
    defs = cat.dim_branch.select(F.concat(F.lit("Branch "), code).alias("name"), "epi_slid", "epi_branchcode") \
        .select(entry.alias("j"))
    # One small JSON document: the definitions of a site's branches (bounded by the dimension).
    doc = defs.agg(F.concat(F.lit('{"reports": ['), F.array_join(F.sort_array(F.collect_list("j")), ","),
                            F.lit("]}")).alias("value"))
    path = ensure_checkpoint_dir(cat.spark).rstrip("/") + f"/definitions-{uuid.uuid4().hex}"
    doc.coalesce(1).write.text(path)
    d = definitions_file(cat.spark, path)
    return d.select("name", F.posexplode("query").alias("query_no", "query"))


@op("s7_sample_top10", """
SELECT * FROM episodes ORDER BY epi_id LIMIT 10
""", ["episodes"])
def _s7(cat, p):
    return cat.episodes.orderBy("epi_id").limit(10)


# ============================================================ P: projections, filters
@op("p1_projection_alias", """
SELECT epi_slid AS line, CAST(year(epi_SocDate) AS INTEGER) AS soc_year, COUNT(*) AS n, CAST(SUM(epi_id % 7) AS BIGINT) AS id_mod_sum
FROM episodes GROUP BY 1, 2
""", ["episodes"])
def _p1(cat, p):
    e = cat.episodes.select(C("epi_slid").alias("line"), F.year("epi_SocDate").alias("soc_year"),
                            (C("epi_id") % 7).alias("id_mod"))
    return e.groupBy("line", "soc_year").agg(N().alias("n"), F.sum("id_mod").alias("id_mod_sum"))


@op("p2_star_projection", """
WITH f AS (SELECT e.*, CASE WHEN upper(trim(epi_RecertFlag)) IN ('Y','1','R','RECERT','TRUE') THEN 1 ELSE 0 END AS is_recert
           FROM episodes e)
SELECT epi_status, is_recert, COUNT(*) AS n, COUNT(DISTINCT epi_paid) AS patients FROM f GROUP BY 1, 2
""", ["episodes"])
def _p2(cat, p):
    f = cat.episodes.select("*", as_flag(flag_in(C("epi_RecertFlag"))).alias("is_recert"))
    return f.groupBy("epi_status", "is_recert").agg(N().alias("n"), F.countDistinct("epi_paid").alias("patients"))


@op("p3_literal_param_columns", """
SELECT epi_slid, {S} AS window_start, {E} AS window_end, {A} AS as_of_date, 100 AS median_los_benchmark,
       CAST(0.400 AS DECIMAL(5,3)) AS hce_factor, 'HH+Palliative' AS label, COUNT(*) AS n
FROM episodes GROUP BY epi_slid
""", ["episodes"])
def _p3(cat, p):
    return cat.episodes.groupBy("epi_slid").agg(N().alias("n")).select(
        "epi_slid", lit_date(p.start).alias("window_start"), lit_date(p.end).alias("window_end"),
        lit_date(p.as_of).alias("as_of_date"), F.lit(100).alias("median_los_benchmark"),
        F.lit(p.hce_factor).cast("decimal(5,3)").alias("hce_factor"), F.lit("HH+Palliative").alias("label"), "n")


@op("p4_eq_neq_filter", """
SELECT 'current_new' AS test, COUNT(*) AS n FROM episodes WHERE rtrim(epi_status) = 'CURRENT' AND rtrim(epi_AdmitType) <> 'READMISSION'
UNION ALL SELECT 'flag_not_n', COUNT(*) FROM episodes WHERE rtrim(epi_RecertFlag) <> 'N'
UNION ALL SELECT 'not_recertified', COUNT(*) FROM episodes WHERE rtrim(epi_status) <> 'RECERTIFIED'
""", ["episodes"])
def _p4(cat, p):
    e = cat.episodes
    parts = [("current_new", same(C("epi_status"), "CURRENT") & differs(C("epi_AdmitType"), "READMISSION")),
             ("flag_not_n", differs(C("epi_RecertFlag"), "N")), ("not_recertified", differs(C("epi_status"), "RECERTIFIED"))]
    return _count_tests(e, parts)


def _count_tests(df, parts):
    out = None
    for name, cond in parts:
        d = df.filter(cond).agg(N().alias("n")).select(F.lit(name).alias("test"), "n")
        out = d if out is None else out.unionByName(d)
    return out


@op("p5_null_tests", """
SELECT epi_status, SUM(CASE WHEN epi_DateOfReferral IS NULL THEN 1 ELSE 0 END)::BIGINT AS no_referral,
       SUM(CASE WHEN epi_DischargeDate IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS discharged,
       SUM(CASE WHEN epi_NonAdmitDate IS NULL THEN 1 ELSE 0 END)::BIGINT AS admitted
FROM episodes GROUP BY epi_status
""", ["episodes"])
def _p5(cat, p):
    return cat.episodes.groupBy("epi_status").agg(
        F.sum(as_flag(C("epi_DateOfReferral").isNull())).alias("no_referral"),
        F.sum(as_flag(C("epi_DischargeDate").isNotNull())).alias("discharged"),
        F.sum(as_flag(C("epi_NonAdmitDate").isNull())).alias("admitted"))


@op("p6_in_list", """
SELECT 'recert_yes' AS test, COUNT(*) AS n FROM episodes WHERE upper(trim(epi_RecertFlag)) IN ('Y','1','R','RECERT','TRUE')
UNION ALL SELECT 'recert_not_yes', COUNT(*) FROM episodes WHERE upper(trim(epi_RecertFlag)) NOT IN ('Y','1','R','RECERT','TRUE')
UNION ALL SELECT 'hold_invoices', COUNT(*) FROM invoices WHERE rtrim(i_status) IN ('HOLD', 'HELD')
""", ["episodes", "invoices"])
def _p6(cat, p):
    key = F.upper(F.trim("epi_RecertFlag"))
    a = _count_tests(cat.episodes, [("recert_yes", flag_in(C("epi_RecertFlag"))),
                                    ("recert_not_yes", ~key.isin(["Y", "1", "R", "RECERT", "TRUE"]))])
    b = _count_tests(cat.invoices, [("hold_invoices", same(C("i_status"), "HOLD", "HELD"))])
    return a.unionByName(b)


@op("p7_date_inclusive_window", """
SELECT CAST(epi_SocDate AS DATE) AS d, COUNT(*) AS n FROM episodes
WHERE CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E} GROUP BY 1
""", ["episodes"])
def _p7(cat, p):
    return cat.episodes.filter(in_window_by_date(C("epi_SocDate"), p.start, p.end)) \
        .groupBy(F.to_date("epi_SocDate").alias("d")).agg(N().alias("n"))


@op("p8_raw_range_window", """
SELECT li_slid, COUNT(*) AS n, CAST(SUM(li_calculatedamount) AS DECIMAL(28,2)) AS amount FROM line_items
WHERE li_servicedate BETWEEN {S} AND {E} GROUP BY li_slid
""", ["line_items"])
def _p8(cat, p):
    return cat.line_items.filter(in_window_raw(C("li_servicedate"), p.start, p.end)) \
        .groupBy("li_slid").agg(N().alias("n"), F.sum("li_calculatedamount").alias("amount"))


@op("p9_half_open_window", """
SELECT epi_status, COUNT(*) AS n FROM episodes
WHERE epi_DischargeDate >= {S} AND epi_DischargeDate < {E1} GROUP BY epi_status
""", ["episodes"])
def _p9(cat, p):
    return cat.episodes.filter(in_window_half_open(C("epi_DischargeDate"), p.start, p.end)) \
        .groupBy("epi_status").agg(N().alias("n"))


@op("p10_point_in_time", """
SELECT epi_slid, epi_status, COUNT(*) AS active FROM episodes
WHERE epi_SocDate <= {A} AND (epi_DischargeDate IS NULL OR epi_DischargeDate > {A}) GROUP BY 1, 2
""", ["episodes"])
def _p10(cat, p):
    return cat.episodes.filter(active_on(C("epi_SocDate"), C("epi_DischargeDate"), p.as_of)) \
        .groupBy("epi_slid", "epi_status").agg(N().alias("active"))


@op("p11_interval_overlap", """
SELECT 'raw' AS variant, epi_slid, COUNT(*) AS n FROM episodes
WHERE epi_SocDate <= {E} AND (epi_DischargeDate IS NULL OR epi_DischargeDate > {S}) GROUP BY epi_slid
UNION ALL
SELECT 'by_date', epi_slid, COUNT(*) FROM episodes
WHERE CAST(epi_SocDate AS DATE) <= {E} AND (epi_DischargeDate IS NULL OR CAST(epi_DischargeDate AS DATE) >= {S})
GROUP BY epi_slid
""", ["episodes"])
def _p11(cat, p):
    e = cat.episodes
    a = e.filter(overlaps_window(C("epi_SocDate"), C("epi_DischargeDate"), p.start, p.end)) \
        .groupBy("epi_slid").agg(N().alias("n")).select(F.lit("raw").alias("variant"), "epi_slid", "n")
    b = e.filter(overlaps_window_by_date(C("epi_SocDate"), C("epi_DischargeDate"), p.start, p.end)) \
        .groupBy("epi_slid").agg(N().alias("n")).select(F.lit("by_date").alias("variant"), "epi_slid", "n")
    return a.unionByName(b)


@op("p12_or_flag_filter", """
SELECT epi_slid, COUNT(*) AS n FROM episodes
WHERE CAST(epi_DateOfReferral AS DATE) BETWEEN {S} AND {E}
   OR (CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E} AND epi_NonAdmitDate IS NULL)
   OR (epi_NonAdmitDate IS NOT NULL AND CAST(epi_NonAdmitDate AS DATE) BETWEEN {S} AND {E})
GROUP BY epi_slid
""", ["episodes"])
def _p12(cat, p):
    ref = in_window_by_date(C("epi_DateOfReferral"), p.start, p.end)
    adm = in_window_by_date(C("epi_SocDate"), p.start, p.end) & C("epi_NonAdmitDate").isNull()
    na = C("epi_NonAdmitDate").isNotNull() & in_window_by_date(C("epi_NonAdmitDate"), p.start, p.end)
    return cat.episodes.filter(ref | adm | na).groupBy("epi_slid").agg(N().alias("n"))


@op("p13_column_guard", """
SELECT epi_slid, CAST(epi_SocDate AS DATE) >= CAST(epi_DateOfReferral AS DATE) AS soc_after_referral, COUNT(*) AS n
FROM episodes WHERE epi_DateOfReferral IS NOT NULL GROUP BY 1, 2
""", ["episodes"])
def _p13(cat, p):
    return cat.episodes.filter(C("epi_DateOfReferral").isNotNull()).groupBy(
        "epi_slid", (F.to_date("epi_SocDate") >= F.to_date("epi_DateOfReferral")).alias("soc_after_referral")
    ).agg(N().alias("n"))


@op("p14_soft_delete_filter", """
SELECT 'claimable_lines' AS test, COUNT(*) AS n, CAST(SUM(li_calculatedamount) AS DECIMAL(28,2)) AS amount FROM line_items
WHERE li_deleted = 0 AND li_void = 0 AND li_includeonclaim = 1
UNION ALL
SELECT 'ended_periods', COUNT(*), NULL FROM pdgm_period WHERE pp_deleted = 0 AND pp_periodEnded = 1
""", ["line_items", "pdgm_period"])
def _p14(cat, p):
    a = cat.line_items.filter(claimable()).agg(N().alias("n"), F.sum("li_calculatedamount").alias("amount")) \
        .select(F.lit("claimable_lines").alias("test"), "n", "amount")
    b = cat.pdgm_period.filter(open_period()).agg(N().alias("n")).select(
        F.lit("ended_periods").alias("test"), "n", F.lit(None).cast("decimal(28,2)").alias("amount"))
    return a.unionByName(b)


@op("p15_hold_predicate", """
SELECT li.li_slid, COUNT(*) AS holds FROM line_items li LEFT JOIN invoices i ON i.i_id = li.li_iid
WHERE li.li_ediexportdate IS NULL OR rtrim(i.i_status) IN ('HOLD', 'HELD') GROUP BY li.li_slid
""", ["line_items", "invoices"])
def _p15(cat, p):
    inv = cat.invoices.select("i_id", "i_status")
    j = cat.line_items.join(inv, inv["i_id"] == C("li_iid"), "left")
    return j.filter(on_hold(C("li_ediexportdate"), C("i_status"))).groupBy("li_slid").agg(N().alias("holds"))


@op("p16_positive_balance_aged", """
SELECT i_status, COUNT(*) AS open_invoices,
       SUM(CASE WHEN date_diff('day', i_postdate, {A}) > 90 THEN 1 ELSE 0 END)::BIGINT AS aged_over_90
FROM invoices WHERE i_balance > 0 AND i_postdate IS NOT NULL AND i_postdate <= {A} GROUP BY i_status
""", ["invoices"])
def _p16(cat, p):
    asof = lit_date(p.as_of)
    return cat.invoices.filter((C("i_balance") > 0) & C("i_postdate").isNotNull()
                               & (C("i_postdate") <= asof.cast("timestamp_ntz"))) \
        .groupBy("i_status").agg(N().alias("open_invoices"),
                                 F.sum(as_flag(F.datediff(asof, C("i_postdate")) > 90)).alias("aged_over_90"))


# ============================================================ J: joins
_DIM = """LEFT JOIN dim_branch db ON db.epi_slid = e.epi_slid AND rtrim(db.epi_branchcode) = rtrim(e.epi_branchcode)"""


@op("j1_left_join_two_keys", f"""
SELECT db.branch_name AS bucket, COUNT(*) AS episodes FROM episodes e {_DIM} GROUP BY db.branch_name
""", ["episodes", "dim_branch"])
def _j1(cat, p):
    return with_bucket(cat.episodes, cat.dim_branch).groupBy("bucket").agg(N().alias("episodes"))


@op("j2_left_join_code_only", """
SELECT db.branch_name, db.service_line, COUNT(*) AS invoices FROM invoices i
LEFT JOIN dim_branch db ON rtrim(db.epi_branchcode) = rtrim(i.i_branchcode)
GROUP BY db.branch_name, db.service_line
""", ["invoices", "dim_branch"])
def _j2(cat, p):
    inv = cat.invoices.withColumnRenamed("i_branchcode", "branch_code")
    return with_branch_by_code(inv, cat.dim_branch).groupBy("branch_name", "service_line") \
        .agg(N().alias("invoices"))


@op("j3_wildcard_join", """
WITH m AS (SELECT * FROM dim_branch UNION ALL SELECT 'HOSPICE', 2, NULL, 'ALL HOSPICE')
SELECT m.branch_name AS bucket, COUNT(*) AS episodes FROM episodes e
LEFT JOIN m ON m.epi_slid = e.epi_slid AND (m.epi_branchcode IS NULL OR rtrim(m.epi_branchcode) = rtrim(e.epi_branchcode))
GROUP BY m.branch_name
""", ["episodes", "dim_branch"])
def _j3(cat, p):
    wild = cat.spark.createDataFrame([("HOSPICE", 2, None, "ALL HOSPICE")], cat.dim_branch.schema)
    return with_bucket(cat.episodes, cat.dim_branch.unionByName(wild), wildcard=True) \
        .groupBy("bucket").agg(N().alias("episodes"))


@op("j4_normalised_key_join", """
SELECT b.branch_name, COUNT(*) AS episodes FROM episodes e JOIN branches b ON rtrim(e.epi_branchcode) = rtrim(b.branch_code)
GROUP BY b.branch_name
""", ["episodes", "branches"])
def _j4(cat, p):
    b = bounded_broadcast(cat.branches, CODE_TABLE_MAX_ROWS,
                          cat.branches.select(F.rtrim("branch_code").alias("_code"), "branch_name"))
    return cat.episodes.join(b, b["_code"] == F.rtrim("epi_branchcode"), "inner").groupBy("branch_name") \
        .agg(N().alias("episodes"))


@op("j5_left_join_right_predicate", """
SELECT e.epi_id IS NOT NULL AS matched, COUNT(*) AS lines FROM line_items li
LEFT JOIN episodes e ON e.epi_id = li.li_epiid AND e.epi_status <> 'DELETED' GROUP BY 1
""", ["line_items", "episodes"])
def _j5(cat, p):
    e = cat.episodes.filter(C("epi_status") != "DELETED").select("epi_id")
    j = cat.line_items.join(e, e["epi_id"] == C("li_epiid"), "left")
    return j.groupBy(C("epi_id").isNotNull().alias("matched")).agg(N().alias("lines"))


@op("j6_inner_join_chain", """
SELECT e.epi_status, sl.sl_desc, COUNT(*) AS periods FROM pdgm_period pp
JOIN episode_fs fs ON fs.cefs_id = pp.pp_cefsId JOIN episodes e ON e.epi_id = fs.cefs_epiid
JOIN service_lines sl ON sl.sl_id = e.epi_slid GROUP BY 1, 2
""", ["pdgm_period", "episode_fs", "episodes", "service_lines"])
def _j6(cat, p):
    fs = cat.episode_fs
    e = cat.episodes.select("epi_id", "epi_status", "epi_slid")
    sl = bounded_broadcast(cat.service_lines, CODE_TABLE_MAX_ROWS)
    j = (cat.pdgm_period.join(fs, fs["cefs_id"] == C("pp_cefsId"), "inner")
         .join(e, e["epi_id"] == C("cefs_epiid"), "inner").join(sl, sl["sl_id"] == C("epi_slid"), "inner"))
    return j.groupBy("epi_status", "sl_desc").agg(N().alias("periods"))


@op("j7_range_join_spine", """
WITH RECURSIVE dates(d) AS (SELECT {S} UNION ALL SELECT CAST(d + 1 AS DATE) FROM dates WHERE d < {E})
SELECT d AS CensusDate, epi_slid, COUNT(DISTINCT epi_paid) AS patients, COUNT(*) AS episode_days
FROM dates JOIN episodes e ON e.epi_SocDate <= d AND (e.epi_DischargeDate IS NULL OR e.epi_DischargeDate > d)
GROUP BY d, epi_slid
""", ["episodes"])
def _j7(cat, p):
    rows = daily_census_rows(cat.episodes, p.start, p.end)
    return rows.groupBy("CensusDate", "epi_slid").agg(F.countDistinct("epi_paid").alias("patients"),
                                                       N().alias("episode_days"))


@op("j8_equi_range_left_join", """
WITH per AS (SELECT pp.pp_id, COUNT(v.cev_id) AS visit_count FROM pdgm_period pp
  JOIN episode_fs fs ON fs.cefs_id = pp.pp_cefsId
  LEFT JOIN visits_all v ON v.cev_epiid = fs.cefs_epiid AND v.cev_deleted = 0 AND v.cev_billable = 1
       AND CAST(v.cev_visitdate AS DATE) BETWEEN pp.pp_startDate AND pp.pp_endDate
  WHERE pp.pp_endDate BETWEEN {S} AND {E} GROUP BY pp.pp_id)
SELECT visit_count, COUNT(*) AS periods FROM per GROUP BY visit_count
""", ["pdgm_period", "episode_fs", "visits_all"])
def _j8(cat, p):
    pp = cat.pdgm_period.filter(C("pp_endDate").between(lit_date(p.start), lit_date(p.end)))
    per = pp.join(cat.episode_fs, C("cefs_id") == C("pp_cefsId"), "inner")
    return kpis.period_visit_counts(cat, per, p.end).groupBy("visit_count").agg(N().alias("periods"))


@op("j9_preaggregated_left_join", """
WITH a AS (SELECT epi_id FROM episodes WHERE CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E}),
f AS (SELECT cev_epiid, MIN(cev_visitdate) AS first_visit, COUNT(*) AS n FROM visits WHERE cev_setsocdateflag = 'Y' GROUP BY 1)
SELECT f.cev_epiid IS NOT NULL AS has_visit, COUNT(*) AS admissions, SUM(f.n)::BIGINT AS visits
FROM a LEFT JOIN f ON f.cev_epiid = a.epi_id GROUP BY 1
""", ["episodes", "visits"])
def _j9(cat, p):
    a = cat.episodes.filter(in_window_by_date(C("epi_SocDate"), p.start, p.end)).select("epi_id")
    f = kpis.only_of(cat.visits.filter(same(C("cev_setsocdateflag"), "Y")), "cev_epiid", a, "epi_id").groupBy("cev_epiid").agg(
        F.min("cev_visitdate").alias("first_visit"), N().alias("n"))
    j = a.join(f, f["cev_epiid"] == a["epi_id"], "left")
    return j.groupBy(C("cev_epiid").isNotNull().alias("has_visit")).agg(N().alias("admissions"),
                                                                          F.sum("n").alias("visits"))


@op("j10_one_to_many_left_join", f"""
SELECT db.branch_name AS bucket, COUNT(*) AS joined_rows, COUNT(DISTINCT e.epi_id) AS episodes
FROM episodes e {_DIM} LEFT JOIN facetoface f ON f.ceftf_f2fappliestoepiid = e.epi_id
WHERE CAST(e.epi_SocDate AS DATE) BETWEEN {{S}} AND {{E}} GROUP BY db.branch_name
""", ["episodes", "dim_branch", "facetoface"])
def _j10(cat, p):
    """COUNT(*) over the one-to-many left join, from per-episode row counts:
    an episode with n matching rows stands for max(n, 1) joined rows."""
    e = with_bucket(cat.episodes.filter(in_window_by_date(C("epi_SocDate"), p.start, p.end)), cat.dim_branch)
    f = kpis.only_of(cat.facetoface, "ceftf_f2fappliestoepiid", e, "epi_id") \
        .groupBy(C("ceftf_f2fappliestoepiid").alias("_f_id")).agg(N().alias("_n"))
    j = e.join(f, f["_f_id"] == e["epi_id"], "left")
    return j.groupBy("bucket").agg(F.sum(F.greatest(F.coalesce(C("_n"), F.lit(0)), F.lit(1))).alias("joined_rows"),
                                   F.countDistinct("epi_id").alias("episodes"))


@op("j11_full_outer_join", f"""
WITH a AS (SELECT db.branch_name AS bucket, COUNT(*) AS episodes FROM episodes e {_DIM}
           WHERE e.epi_status = 'CURRENT' GROUP BY 1),
b AS (SELECT db.branch_name AS bucket, COUNT(*) AS lines FROM line_items li
      LEFT JOIN episodes e ON e.epi_id = li.li_epiid
      LEFT JOIN dim_branch db ON db.epi_slid = li.li_slid AND rtrim(db.epi_branchcode) = rtrim(e.epi_branchcode)
      WHERE li.li_servicedate BETWEEN {{S}} AND {{E}} GROUP BY 1)
SELECT coalesce(a.bucket, b.bucket) AS bucket, coalesce(a.episodes, 0) AS episodes, coalesce(b.lines, 0) AS lines
FROM a FULL OUTER JOIN b ON a.bucket = b.bucket
""", ["episodes", "line_items", "dim_branch"])
def _j11(cat, p):
    a = with_bucket(cat.episodes.filter(same(C("epi_status"), "CURRENT")), cat.dim_branch) \
        .groupBy("bucket").agg(N().alias("episodes")).alias("a")
    li = cat.line_items.filter(in_window_raw(C("li_servicedate"), p.start, p.end))
    e = kpis.only_of(cat.episodes.select("epi_id", "epi_branchcode"), "epi_id", li, "li_epiid")
    b = with_bucket(li.join(e, e["epi_id"] == li["li_epiid"], "left"), cat.dim_branch, slid="li_slid") \
        .groupBy("bucket").agg(N().alias("lines")).alias("b")
    j = a.join(b, C("a.bucket") == C("b.bucket"), "full_outer")
    return j.select(F.coalesce(C("a.bucket"), C("b.bucket")).alias("bucket"),
                    F.coalesce(C("a.episodes"), F.lit(0)).alias("episodes"),
                    F.coalesce(C("b.lines"), F.lit(0)).alias("lines"))


@op("j12_null_rejected_left_join", """
SELECT db.branch_name AS bucket, COUNT(*) AS episodes FROM episodes e
LEFT JOIN dim_branch db ON db.epi_slid = e.epi_slid
  AND (db.epi_branchcode IS NULL OR rtrim(db.epi_branchcode) = rtrim(e.epi_branchcode))
WHERE db.service_line = 'HOME HEALTH' GROUP BY 1
""", ["episodes", "dim_branch"])
def _j12(cat, p):
    e = with_bucket(cat.episodes, cat.dim_branch, wildcard=True, keep_service_line=True)
    return e.filter(C("_dim_service_line") == "HOME HEALTH").groupBy("bucket").agg(N().alias("episodes"))


@op("j13_coalesce_key_source", """
SELECT rtrim(coalesce(i.i_branchcode, e.epi_branchcode)) AS branch_code, COUNT(*) AS lines
FROM line_items li LEFT JOIN invoices i ON i.i_id = li.li_iid LEFT JOIN episodes e ON e.epi_id = li.li_epiid
GROUP BY 1
""", ["line_items", "invoices", "episodes"])
def _j13(cat, p):
    j = kpis._lines_with_branch(cat, cat.line_items, with_invoice=True)
    return j.groupBy(F.rtrim("branch_code").alias("branch_code")).agg(N().alias("lines"))


# ============================================================ A: aggregations
@op("a1_count_star_by_key", """
SELECT epi_DcCode, COUNT(*) AS n FROM episodes GROUP BY epi_DcCode
""", ["episodes"])
def _a1(cat, p):
    return cat.episodes.groupBy("epi_DcCode").agg(N().alias("n"))


@op("a2_count_col_outer", """
WITH per AS (SELECT e.epi_id, COUNT(r.cerh_epiid) AS recerts FROM episodes e
             LEFT JOIN recert_history r ON r.cerh_epiid = e.epi_id GROUP BY e.epi_id)
SELECT recerts, COUNT(*) AS episodes FROM per GROUP BY recerts
""", ["episodes", "recert_history"])
def _a2(cat, p):
    r = cat.recert_history.groupBy("cerh_epiid").agg(N().alias("_n"))
    j = cat.episodes.select("epi_id").join(r, r["cerh_epiid"] == C("epi_id"), "left")
    return j.groupBy(F.coalesce(C("_n"), F.lit(0)).alias("recerts")).agg(N().alias("episodes"))


@op("a3_count_distinct", """
SELECT epi_slid, COUNT(DISTINCT epi_paid) AS patients FROM episodes GROUP BY epi_slid
""", ["episodes"])
def _a3(cat, p):
    return cat.episodes.groupBy("epi_slid").agg(F.countDistinct("epi_paid").alias("patients"))


@op("a4_count_distinct_expr", """
SELECT epi_status, COUNT(DISTINCT rtrim(epi_DcCode)) AS codes FROM episodes GROUP BY epi_status
""", ["episodes"])
def _a4(cat, p):
    return cat.episodes.groupBy("epi_status").agg(F.countDistinct(F.rtrim("epi_DcCode")).alias("codes"))


@op("a5_sum_decimal", """
SELECT li_slid, CAST(SUM(li_calculatedamount) AS DECIMAL(28,2)) AS amount FROM line_items GROUP BY li_slid
""", ["line_items"])
def _a5(cat, p):
    return cat.line_items.groupBy("li_slid").agg(F.sum("li_calculatedamount").alias("amount"))


@op("a6_sum_flags", """
SELECT epi_status, SUM(CASE WHEN upper(trim(epi_RecertFlag)) IN ('Y','1','R','RECERT','TRUE') THEN 1 ELSE 0 END)::BIGINT AS recerts
FROM episodes GROUP BY epi_status
""", ["episodes"])
def _a6(cat, p):
    return cat.episodes.groupBy("epi_status").agg(F.sum(as_flag(flag_in(C("epi_RecertFlag")))).alias("recerts"))


@op("a7_conditional_sum", """
SELECT li_slid, CAST(SUM(CASE WHEN li_ediexportdate IS NULL THEN li_calculatedamount ELSE 0 END) AS DECIMAL(28,2)) AS unexported_amount,
       SUM(CASE WHEN li_void = 1 THEN 1 ELSE 0 END)::BIGINT AS voided
FROM line_items GROUP BY li_slid
""", ["line_items"])
def _a7(cat, p):
    return cat.line_items.groupBy("li_slid").agg(
        F.sum(F.when(C("li_ediexportdate").isNull(), C("li_calculatedamount")).otherwise(F.lit(0)))
        .alias("unexported_amount"),
        F.sum(as_flag(C("li_void") == 1)).alias("voided"))


@op("a8_aging_pivot", """
WITH a AS (SELECT i_status, i_balance, date_diff('day', i_postdate, {A}) AS age FROM invoices
           WHERE i_balance > 0 AND i_postdate IS NOT NULL AND i_postdate <= {A})
SELECT i_status, CAST(SUM(CASE WHEN age <= 30 THEN i_balance ELSE 0 END) AS DECIMAL(28,2)) AS ar_0_30,
       CAST(SUM(CASE WHEN age BETWEEN 31 AND 60 THEN i_balance ELSE 0 END) AS DECIMAL(28,2)) AS ar_31_60,
       CAST(SUM(CASE WHEN age BETWEEN 61 AND 90 THEN i_balance ELSE 0 END) AS DECIMAL(28,2)) AS ar_61_90,
       CAST(SUM(CASE WHEN age > 90 THEN i_balance ELSE 0 END) AS DECIMAL(28,2)) AS ar_over_90,
       CAST(SUM(i_balance) AS DECIMAL(28,2)) AS ar_total
FROM a GROUP BY i_status
""", ["invoices"])
def _a8(cat, p):
    asof = lit_date(p.as_of)
    a = cat.invoices.filter((C("i_balance") > 0) & C("i_postdate").isNotNull()
                            & (C("i_postdate") <= asof.cast("timestamp_ntz"))) \
        .withColumn("age", F.datediff(asof, C("i_postdate")))
    return a.groupBy("i_status").agg(*aging_sums(C("age"), C("i_balance")))


@op("a9_avg_decimal", """
SELECT epi_slid, CAST(AVG(date_diff('day', epi_SocDate, epi_DischargeDate) * 1.0) AS DECIMAL(10,1)) AS avg_los
FROM episodes WHERE epi_DischargeDate IS NOT NULL GROUP BY epi_slid
""", ["episodes"])
def _a9(cat, p):
    return cat.episodes.filter(C("epi_DischargeDate").isNotNull()).groupBy("epi_slid").agg(
        avg_dec(days_between("epi_SocDate", "epi_DischargeDate"), "decimal(10,1)").alias("avg_los"))


@op("a10_min_attribute", """
SELECT epi_slid, MIN(epi_SocDate) AS first_soc, MIN(epi_branchcode) AS first_code, MIN(epi_DcCode) AS first_dc
FROM episodes GROUP BY epi_slid
""", ["episodes"])
def _a10(cat, p):
    return cat.episodes.groupBy("epi_slid").agg(F.min("epi_SocDate").alias("first_soc"),
                                                F.min("epi_branchcode").alias("first_code"),
                                                F.min("epi_DcCode").alias("first_dc"))


@op("a11_bool_or", """
SELECT epi_slid, epi_status, CAST(MAX(CAST(epi_RecertFlag = 'Y' AS INTEGER)) AS BOOLEAN) AS any_recert
FROM episodes GROUP BY 1, 2
""", ["episodes"])
def _a11(cat, p):
    return cat.episodes.groupBy("epi_slid", "epi_status").agg(
        F.bool_or(C("epi_RecertFlag") == "Y").alias("any_recert"))


@op("a12_safe_ratio", f"""
WITH g AS (SELECT db.branch_name AS bucket, COUNT(*) AS n,
                  SUM(CASE WHEN e.epi_DischargeDate IS NULL THEN 1 ELSE 0 END) AS open_n,
                  SUM(CASE WHEN e.epi_status = 'CURRENT' AND e.epi_DischargeDate IS NOT NULL AND
                      CAST(e.epi_DischargeDate AS DATE) = {{E}} THEN 1 ELSE 0 END) AS closing_today
           FROM episodes e {_DIM} GROUP BY 1)
SELECT bucket, CAST(open_n * 100.0 / NULLIF(n, 0) AS DECIMAL(5,1)) AS pct_nullif,
       CAST(CASE WHEN closing_today > 0 THEN open_n * 100.0 / closing_today ELSE NULL END AS DECIMAL(10,1)) AS pct_positive,
       CAST(CASE WHEN closing_today = 0 THEN 0 ELSE closing_today * 100.0 / n END AS DECIMAL(6,2)) AS pct_zero
FROM g
""", ["episodes", "dim_branch"])
def _a12(cat, p):
    e = with_bucket(cat.episodes, cat.dim_branch)
    closing = (C("epi_status") == "CURRENT") & C("epi_DischargeDate").isNotNull() \
        & (F.to_date("epi_DischargeDate") == lit_date(p.end))
    g = e.groupBy("bucket").agg(N().alias("n"), F.sum(as_flag(C("epi_DischargeDate").isNull())).alias("open_n"),
                                F.sum(as_flag(closing)).alias("closing_today"))
    return g.select("bucket",
                    ratio_pct(C("open_n"), C("n"), "decimal(5,1)").alias("pct_nullif"),
                    ratio_pct(C("open_n"), C("closing_today"), "decimal(10,1)", guard="positive").alias("pct_positive"),
                    ratio_pct(C("closing_today"), C("n"), "decimal(6,2)", guard="zero").alias("pct_zero"))


@op("a13_threshold_share", """
WITH d AS (SELECT epi_slid, date_diff('day', epi_DateOfReferral, epi_SocDate) AS days FROM episodes
           WHERE epi_DateOfReferral IS NOT NULL AND CAST(epi_SocDate AS DATE) >= CAST(epi_DateOfReferral AS DATE))
SELECT epi_slid, CAST(SUM(CASE WHEN days <= 2 THEN 1 ELSE 0 END) * 100.0 / COUNT(*) AS DECIMAL(5,2)) AS pct_within_2_days
FROM d GROUP BY epi_slid
""", ["episodes"])
def _a13(cat, p):
    d = cat.episodes.filter(C("epi_DateOfReferral").isNotNull()
                            & (F.to_date("epi_SocDate") >= F.to_date("epi_DateOfReferral"))) \
        .withColumn("days", days_between("epi_DateOfReferral", "epi_SocDate"))
    return d.groupBy("epi_slid").agg(
        ratio_pct(F.sum(as_flag(C("days") <= 2)), N(), "decimal(5,2)").alias("pct_within_2_days"))


@op("a14_group_by_expr", """
SELECT coalesce(ct.ctype_description, '(no primary care type)') AS care_type, COUNT(*) AS n
FROM episode_care_types cect LEFT JOIN care_types ct ON ct.ctype_id = cect.cect_ctypeid
WHERE cect.cect_primary = 'Y' GROUP BY 1
""", ["episode_care_types", "care_types"])
def _a14(cat, p):
    ct = bounded_broadcast(cat.care_types, CODE_TABLE_MAX_ROWS)
    j = cat.episode_care_types.filter(C("cect_primary") == "Y").join(ct, ct["ctype_id"] == C("cect_ctypeid"), "left")
    return j.groupBy(fill(C("ctype_description"), "(no primary care type)").alias("care_type")).agg(N().alias("n"))


@op("a15_multi_key_group", """
SELECT epi_status, epi_AdmitType, epi_slid, COUNT(*) AS n FROM episodes GROUP BY 1, 2, 3
""", ["episodes"])
def _a15(cat, p):
    return cat.episodes.groupBy("epi_status", "epi_AdmitType", "epi_slid").agg(N().alias("n"))


@op("a16_global_aggregate", """
SELECT 'test_window' AS run, COUNT(*) AS n, SUM(date_diff('day', epi_SocDate, {E}))::BIGINT AS days
FROM episodes WHERE CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E}
UNION ALL
SELECT 'empty_window', COUNT(*), SUM(date_diff('day', epi_SocDate, DATE '2035-01-15'))::BIGINT
FROM episodes WHERE CAST(epi_SocDate AS DATE) BETWEEN DATE '2035-01-01' AND DATE '2035-01-15'
""", ["episodes"])
def _a16(cat, p):
    out = None
    for run, q in (("test_window", p), ("empty_window", FUTURE)):
        g = cat.episodes.filter(in_window_by_date(C("epi_SocDate"), q.start, q.end)).agg(
            N().alias("n"), F.sum(days_between("epi_SocDate", lit_date(q.end))).alias("days"))
        g = g.select(F.lit(run).alias("run"), "n", "days")
        out = g if out is None else out.unionByName(g)
    return out


@op("a17_two_level_aggregation", f"""
WITH census AS (SELECT db.service_line, db.branch_name, COUNT(*) AS c FROM episodes e {_DIM}
                WHERE e.epi_SocDate <= {{A}} AND (e.epi_DischargeDate IS NULL OR e.epi_DischargeDate > {{A}})
                GROUP BY 1, 2)
SELECT CAST(SUM(c) AS BIGINT) AS total, CAST(SUM(CASE WHEN service_line = 'HOSPICE' THEN c ELSE 0 END) AS BIGINT) AS hospice,
       COUNT(*) AS branches
FROM census
""", ["episodes", "dim_branch"])
def _a17(cat, p):
    e = with_bucket(cat.episodes.filter(active_on(C("epi_SocDate"), C("epi_DischargeDate"), p.as_of)),
                    cat.dim_branch, keep_service_line=True)
    census = e.groupBy("_dim_service_line", "bucket").agg(N().alias("c"))
    return census.agg(F.sum("c").alias("total"),
                      F.sum(F.when(C("_dim_service_line") == "HOSPICE", C("c")).otherwise(F.lit(0))).alias("hospice"),
                      N().alias("branches"))


@op("a18_dedup_by_key", """
SELECT epi_paid, MIN(epi_SocDate) AS first_soc, bool_or(epi_status = 'CURRENT') AS any_current
FROM episodes GROUP BY epi_paid
""", ["episodes"])
def _a18(cat, p):
    return cat.episodes.groupBy("epi_paid").agg(F.min("epi_SocDate").alias("first_soc"),
                                                F.bool_or(C("epi_status") == "CURRENT").alias("any_current"))


@op("a19_exact_median", """
SELECT epi_slid, CAST(quantile_cont(date_diff('day', epi_SocDate, epi_DischargeDate), 0.5) AS DECIMAL(10,1)) AS median_los
FROM episodes WHERE epi_DischargeDate IS NOT NULL GROUP BY epi_slid
""", ["episodes"])
def _a19(cat, p):
    return cat.episodes.filter(C("epi_DischargeDate").isNotNull()).groupBy("epi_slid").agg(
        F.percentile(days_between("epi_SocDate", "epi_DischargeDate"), 0.5).cast("decimal(10,1)").alias("median_los"))


@op("a20_zero_floored_sum", """
SELECT epi_slid, SUM(CASE WHEN d > 0 THEN d ELSE 0 END)::BIGINT AS positive_days FROM
  (SELECT epi_slid, date_diff('day', epi_SocDate, epi_DischargeDate) AS d FROM episodes) t GROUP BY epi_slid
""", ["episodes"])
def _a20(cat, p):
    d = days_between("epi_SocDate", "epi_DischargeDate")
    return cat.episodes.groupBy("epi_slid").agg(F.sum(F.coalesce(zero_floor(d), F.lit(0))).alias("positive_days"))


# ============================================================ W, O, U
@op("w1_percentile_over_partition", f"""
WITH d AS (SELECT db.branch_name AS bucket, date_diff('day', e.epi_SocDate, e.epi_DischargeDate) AS los
           FROM episodes e {_DIM} WHERE e.epi_DischargeDate IS NOT NULL),
w AS (SELECT bucket, quantile_cont(los, 0.5) OVER (PARTITION BY bucket) AS m FROM d)
SELECT bucket, CAST(m AS DECIMAL(10,1)) AS median_los, COUNT(*) AS rows_with_median FROM w GROUP BY bucket, m
""", ["episodes", "dim_branch"])
def _w1(cat, p):
    """The windowed median attached to every row.  A window partition would
    sort a whole (possibly hot) bucket inside one task, so the median is
    aggregated per bucket (partial aggregation) and joined back; the
    per-bucket result is bounded by the branch dimension."""
    d = with_bucket(cat.episodes.filter(C("epi_DischargeDate").isNotNull()), cat.dim_branch) \
        .withColumn("los", days_between("epi_SocDate", "epi_DischargeDate"))
    med = d.groupBy("bucket").agg(F.percentile("los", 0.5).alias("m"))
    # One row per bucket: the planner sees its size at run time and picks the join.
    rows = d.join(med, d["bucket"].eqNullSafe(med["bucket"]), "inner").drop(med["bucket"])
    return rows.groupBy("bucket", "m").agg(N().alias("rows_with_median")) \
        .select("bucket", C("m").cast("decimal(10,1)").alias("median_los"), "rows_with_median")


@op("o1_multi_key_sort")
def _o1(cat, p):
    from careledger.operators.branching import by_bucket
    return by_bucket(with_bucket(cat.episodes, cat.dim_branch), [N().alias("n")])


@op("o2_sort_by_aggregate", """
SELECT epi_slid, epi_NonAdmitCode, COUNT(*) AS n FROM episodes WHERE epi_NonAdmitCode IS NOT NULL
GROUP BY 1, 2 ORDER BY epi_slid, n DESC
""", ["episodes"])
def _o2(cat, p):
    return cat.episodes.filter(C("epi_NonAdmitCode").isNotNull()).groupBy("epi_slid", "epi_NonAdmitCode") \
        .agg(N().alias("n")).orderBy(C("epi_slid"), C("n").desc())


@op("o3_sort_detail_by_date", """
SELECT epi_id, epi_SocDate, epi_status FROM episodes WHERE CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E}
ORDER BY epi_SocDate, epi_id
""", ["episodes"])
def _o3(cat, p):
    return cat.episodes.filter(in_window_by_date(C("epi_SocDate"), p.start, p.end)) \
        .select("epi_id", "epi_SocDate", "epi_status").orderBy("epi_SocDate", "epi_id")


@op("u1_union_all", """
SELECT 'admission' AS kind, CAST(epi_SocDate AS DATE) AS d, COUNT(*) AS n FROM episodes
WHERE CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E} GROUP BY 2
UNION ALL
SELECT 'discharge', CAST(epi_DischargeDate AS DATE), COUNT(*) FROM episodes
WHERE epi_DischargeDate >= {S} AND epi_DischargeDate < {E1} GROUP BY 2
""", ["episodes"])
def _u1(cat, p):
    e = cat.episodes
    a = e.filter(in_window_by_date(C("epi_SocDate"), p.start, p.end)).groupBy(
        F.to_date("epi_SocDate").alias("d")).agg(N().alias("n")).select(F.lit("admission").alias("kind"), "d", "n")
    b = e.filter(in_window_half_open(C("epi_DischargeDate"), p.start, p.end)).groupBy(
        F.to_date("epi_DischargeDate").alias("d")).agg(N().alias("n")).select(F.lit("discharge").alias("kind"), "d", "n")
    return a.unionAll(b)


# ============================================================ F: scalar functions
@op("f1_isnull_label", """
SELECT coalesce(epi_NonAdmitCode, '(unknown reason)') AS reason, COUNT(*) AS n FROM episodes GROUP BY 1
""", ["episodes"])
def _f1(cat, p):
    return cat.episodes.groupBy(fill(C("epi_NonAdmitCode"), "(unknown reason)").alias("reason")).agg(N().alias("n"))


@op("f2_nested_isnull_label", """
SELECT coalesce(db.branch_name, nullif(trim(i.i_branchcode), ''), '(no branch)') AS bucket, COUNT(*) AS n
FROM invoices i LEFT JOIN dim_branch db ON rtrim(db.epi_branchcode) = rtrim(i.i_branchcode) GROUP BY 1
""", ["invoices", "dim_branch"])
def _f2(cat, p):
    j = with_branch_by_code(cat.invoices.withColumnRenamed("i_branchcode", "branch_code"), cat.dim_branch)
    return j.groupBy(label_or_code(C("branch_name"), C("branch_code")).alias("bucket")).agg(N().alias("n"))


@op("f3_coalesce", """
SELECT CAST(year(coalesce(epi_DischargeDate, epi_NonAdmitDate, epi_SocDate)) AS INTEGER) AS y, COUNT(*) AS n FROM episodes GROUP BY 1
""", ["episodes"])
def _f3(cat, p):
    return cat.episodes.groupBy(F.year(F.coalesce("epi_DischargeDate", "epi_NonAdmitDate", "epi_SocDate")).alias("y")) \
        .agg(N().alias("n"))


@op("f4_nullif", """
SELECT nullif(trim(i_branchcode), '') AS code, COUNT(*) AS n, SUM(i_balance) / NULLIF(COUNT(*) - COUNT(*), 0) AS guarded
FROM invoices GROUP BY 1
""", ["invoices"])
def _f4(cat, p):
    return cat.invoices.groupBy(blank_to_null(C("i_branchcode")).alias("code")).agg(
        N().alias("n"), (F.sum("i_balance") / F.nullif(N() - N(), F.lit(0))).cast("double").alias("guarded"))


@op("f5_case_when", """
SELECT CASE WHEN epi_status = 'CURRENT' THEN 'active' WHEN epi_status = 'DISCHARGED' THEN 'closed' END AS state,
       COUNT(*) AS n FROM episodes GROUP BY 1
""", ["episodes"])
def _f5(cat, p):
    s = F.when(C("epi_status") == "CURRENT", "active").when(C("epi_status") == "DISCHARGED", "closed")
    return cat.episodes.groupBy(s.alias("state")).agg(N().alias("n"))


@op("f6_trims", """
SELECT '[' || ltrim(epi_RecertFlag) || ']' AS l, '[' || rtrim(epi_RecertFlag) || ']' AS r,
       '[' || trim(epi_RecertFlag) || ']' AS t, COUNT(*) AS n FROM episodes GROUP BY 1, 2, 3
""", ["episodes"])
def _f6(cat, p):
    w = lambda c: F.concat(F.lit("["), c, F.lit("]"))
    return cat.episodes.groupBy(w(F.ltrim("epi_RecertFlag")).alias("l"), w(F.rtrim("epi_RecertFlag")).alias("r"),
                                w(F.trim("epi_RecertFlag")).alias("t")).agg(N().alias("n"))


@op("f7_flag_normalise", """
SELECT epi_RecertFlag AS flag,
       upper(trim(epi_RecertFlag)) IN ('Y','1','R','RECERT','TRUE') AS yes_raw,
       upper(trim(coalesce(epi_RecertFlag, ''))) IN ('Y','1','R','RECERT','TRUE') AS yes_filled, COUNT(*) AS n
FROM episodes GROUP BY 1, 2, 3
""", ["episodes"])
def _f7(cat, p):
    f = C("epi_RecertFlag")
    return cat.episodes.groupBy(f.alias("flag"), flag_in(f).alias("yes_raw"),
                                flag_in(f, null_as_blank=True).alias("yes_filled")).agg(N().alias("n"))


@op("f8_cast_date", """
SELECT CAST(epi_SocDate AS DATE) AS soc_date, COUNT(*) AS n FROM episodes GROUP BY 1
""", ["episodes"])
def _f8(cat, p):
    return cat.episodes.groupBy(F.to_date("epi_SocDate").alias("soc_date")).agg(N().alias("n"))


@op("f9_cast_decimal", """
SELECT epi_slid, CAST(COUNT(*) * 100.0 / 16 AS DECIMAL(10,1)) AS per_16, CAST(COUNT(*) / 3.0 AS DECIMAL(10,2)) AS per_3
FROM episodes GROUP BY epi_slid
""", ["episodes"])
def _f9(cat, p):
    return cat.episodes.groupBy("epi_slid").agg(
        (N() * F.lit(Decimal("100.0")) / F.lit(16)).cast("decimal(10,1)").alias("per_16"),
        (N() / F.lit(Decimal("3.0"))).cast("decimal(10,2)").alias("per_3"))


@op("f10_bit_int_casts", """
SELECT CAST(ceftf_active AS BOOLEAN) AS active_bit, CAST(CAST(ceftf_active AS BOOLEAN) AS INTEGER) AS active_int,
       COUNT(*) AS n FROM facetoface GROUP BY 1, 2
""", ["facetoface"])
def _f10(cat, p):
    b = C("ceftf_active").cast("boolean")
    return cat.facetoface.groupBy(b.alias("active_bit"), b.cast("int").alias("active_int")).agg(N().alias("n"))


@op("f11_round2", """
SELECT epi_slid, CAST(round(100.0 * SUM(CASE WHEN epi_DischargeDate IS NULL THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0), 2)
       AS DECIMAL(10,2)) AS open_pct FROM episodes GROUP BY epi_slid
""", ["episodes"])
def _f11(cat, p):
    share = F.lit(Decimal("100.0")) * F.sum(as_flag(C("epi_DischargeDate").isNull())) / F.nullif(N(), F.lit(0))
    return cat.episodes.groupBy("epi_slid").agg(F.round(share, 2).cast("decimal(10,2)").alias("open_pct"))


@op("f12_datediff_day", """
SELECT CAST(date_diff('day', epi_DateOfReferral, epi_SocDate) AS INTEGER) AS days, COUNT(*) AS n FROM episodes GROUP BY 1
""", ["episodes"])
def _f12(cat, p):
    return cat.episodes.groupBy(days_between("epi_DateOfReferral", "epi_SocDate").alias("days")).agg(N().alias("n"))


@op("f13_datediff_hour", """
SELECT CAST(date_diff('hour', e.epi_SocDate, v.cev_visitdate) AS INTEGER) AS hours, COUNT(*) AS n
FROM episodes e JOIN visits v ON v.cev_epiid = e.epi_id
WHERE CAST(e.epi_SocDate AS DATE) BETWEEN {S} AND {E} GROUP BY 1
""", ["episodes", "visits"])
def _f13(cat, p):
    e = cat.episodes.filter(in_window_by_date(C("epi_SocDate"), p.start, p.end)).select("epi_id", "epi_SocDate")
    j = e.join(cat.visits.select("cev_epiid", "cev_visitdate"), C("cev_epiid") == C("epi_id"), "inner")
    return j.groupBy(hour_boundaries("epi_SocDate", "cev_visitdate").alias("hours")).agg(N().alias("n"))


@op("f14_dateadd", """
SELECT CAST(epi_SocDate AS DATE) + 3 AS plus_3, CAST(epi_SocDate AS DATE) - 14 AS minus_14, COUNT(*) AS n
FROM episodes WHERE CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E} GROUP BY 1, 2
""", ["episodes"])
def _f14(cat, p):
    d = F.to_date("epi_SocDate")
    return cat.episodes.filter(in_window_by_date(C("epi_SocDate"), p.start, p.end)).groupBy(
        F.date_add(d, 3).alias("plus_3"), F.date_add(d, -14).alias("minus_14")).agg(N().alias("n"))


@op("f16_interval_clip", """
WITH o AS (SELECT date_diff('day',
             CASE WHEN epi_SocDate > {S} THEN epi_SocDate ELSE CAST({S} AS TIMESTAMP) END,
             CASE WHEN epi_DischargeDate IS NULL OR epi_DischargeDate > {E} THEN CAST({E1} AS TIMESTAMP)
                  ELSE epi_DischargeDate END) AS days
           FROM episodes WHERE epi_SocDate <= {E} AND (epi_DischargeDate IS NULL OR epi_DischargeDate > {S}))
SELECT CAST(days AS INTEGER) AS days, COUNT(*) AS n FROM o GROUP BY days
""", ["episodes"])
def _f16(cat, p):
    e = cat.episodes.filter(overlaps_window(C("epi_SocDate"), C("epi_DischargeDate"), p.start, p.end))
    d = days_between(clip_start(C("epi_SocDate"), p.start), clip_end(C("epi_DischargeDate"), p.end))
    return e.groupBy(d.alias("days")).agg(N().alias("n"))


@op("f17_arithmetic_promotion", """
SELECT epi_slid, CAST(SUM(epi_id % 10) * 1.0 / COUNT(*) AS DECIMAL(12,4)) AS mean_mod,
       CAST(SUM(epi_id % 10) * 100.0 / (COUNT(*) + 1) AS DECIMAL(12,3)) AS pct_plus_one,
       CAST(SUM(epi_id % 10) - 14 AS BIGINT) AS minus_n
FROM episodes GROUP BY epi_slid
""", ["episodes"])
def _f17(cat, p):
    m = (C("epi_id") % 10).cast("int")
    return cat.episodes.groupBy("epi_slid").agg(
        (F.sum(m) * F.lit(Decimal("1.0")) / N()).cast("decimal(12,4)").alias("mean_mod"),
        (F.sum(m) * F.lit(Decimal("100.0")) / (N() + 1)).cast("decimal(12,3)").alias("pct_plus_one"),
        (F.sum(m) - 14).alias("minus_n"))


@op("f18_unicode_literal", f"""
WITH g AS (SELECT db.branch_name AS bucket, 100.0 * SUM(CASE WHEN e.epi_DischargeDate IS NULL THEN 1 ELSE 0 END)
                  / NULLIF(COUNT(*), 0) AS pct FROM episodes e {_DIM} GROUP BY 1)
SELECT bucket, CASE WHEN pct >= 80 THEN '✅ Meets KPI (>=80%)' ELSE '❌ Below KPI' END AS kpi_status FROM g
""", ["episodes", "dim_branch"])
def _f18(cat, p):
    e = with_bucket(cat.episodes, cat.dim_branch)
    g = e.groupBy("bucket").agg((F.lit(Decimal("100.0")) * F.sum(as_flag(C("epi_DischargeDate").isNull()))
                                 / F.nullif(N(), F.lit(0))).alias("pct"))
    return g.select("bucket", F.when(C("pct") >= 80, kpis.BP1_MEETS).otherwise(kpis.BP1_BELOW).alias("kpi_status"))


_RANK_SQL = "CASE WHEN db.service_line = 'HOME HEALTH' THEN 1 WHEN db.service_line = 'HOSPICE' THEN 2 ELSE 99 END"
_SQL["o1_multi_key_sort"] = (f"""
SELECT coalesce(db.branch_name, '(unmapped)') AS bucket, MIN({_RANK_SQL}) AS bucket_sort, COUNT(*) AS n
FROM episodes e {_DIM} GROUP BY db.branch_name ORDER BY bucket_sort, bucket
""", ["episodes", "dim_branch"])


# ============================================================ raw entries (read tables directly)
def _raw(name: str, sql: str | None = None, tables: list[str] | None = None):
    def deco(fn):
        _RAW[name] = fn
        if sql is not None:
            _SQL[name] = (sql, tables or [])
        return fn
    return deco


@_raw("f15_default_run_date", """
SELECT CAST(o_orderdate AS DATE) <= current_date AS before_end,
       CAST(o_orderdate AS DATE) >= current_date - 14 AS after_start, COUNT(*) AS n
FROM orders GROUP BY ALL
""", [])
def _f15_raw(spark, sf_dir):
    """No run date given: ``RunParams.build`` takes today as the end and as-of day, 14 days back as the start."""
    p = RunParams.build()
    day = F.to_date("o_orderdate")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(
        (day <= lit_date(p.end)).alias("before_end"), (day >= lit_date(p.start)).alias("after_start")).agg(N().alias("n"))


@_raw("r1_run_params", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders)
SELECT as_of, as_of - 14 AS start, as_of AS "end", as_of + 3 AS sla_cutoff, CAST(0.400 AS DECIMAL(5,3)) AS hce_factor
FROM d
""", [])
def _r1(spark, sf_dir):
    """The parameters of a run on each day that has orders, by the defaults of ``RunParams.build``."""
    days = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("as_of")).distinct()
    named = zip(run_days(C("as_of"), F.date_add), ("as_of", "start", "end", "sla_cutoff"), strict=True)
    return days.select(*[day.alias(name) for day, name in named], F.lit(HCE_FACTOR).cast("decimal(5,3)").alias("hce_factor"))


_R2_SQL = """
USE default;
SELECT epi_slid, rtrim(epi_status) AS status, count(*) AS admissions, :site AS site
FROM episodes
WHERE epi_SocDate >= CAST(:start AS TIMESTAMP_NTZ) AND epi_SocDate < CAST(date_add(:end, 1) AS TIMESTAMP_NTZ)
GROUP BY ALL
"""


@_raw("r2_run_query", """
SELECT epi_slid, rtrim(epi_status) AS status, count(*) AS admissions, 'north' AS site
FROM episodes WHERE CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E} GROUP BY ALL
""", ["episodes"])
def _r2(spark, sf_dir):
    """A batch with a setup line, the run's own parameters and one extra named parameter."""
    from careledger.reports import run_query
    bind_driver_tables(spark, sf_dir).register_views()
    return run_query(spark, _R2_SQL, test_params(), site="north")


@_raw("r3_stack_results")
def _r3(spark, sf_dir):
    from careledger.reports import stack_results
    cat, p = bind_driver_tables(spark, sf_dir), test_params()
    return stack_results([kpis.k06_discharges_total(cat, p), kpis.k07_discharges_by_class(cat, p),
                          kpis.k08_live_discharge_summary(cat, p)])


@_raw("r4_placeholder_if_empty", """
SELECT 'No rows returned' AS "No data" WHERE NOT EXISTS (
  SELECT 1 FROM episodes WHERE epi_status <> 'DELETED' AND epi_NonAdmitDate IS NULL
    AND CAST(epi_SocDate AS DATE) BETWEEN DATE '2035-01-01' AND DATE '2035-01-15')
""", ["episodes"])
def _r4(spark, sf_dir):
    from careledger.reports import placeholder_if_empty
    return placeholder_if_empty(kpis.k17_bp1_detail(bind_driver_tables(spark, sf_dir), FUTURE))


def _flat(spark: SparkSession, paths: dict[str, str], keep: dict[str, list[str]]) -> DataFrame:
    """Written reports read back: (report, output, row) with the row's kept columns as text."""
    out = None
    for name, path in paths.items():
        row = F.concat_ws("|", *[F.coalesce(C(f"`{c}`").cast("string"), F.lit("-")) for c in keep[name]])
        d = spark.read.parquet(path).select(F.lit(name).alias("report"), F.lit(path.rsplit("/", 1)[-1]).alias("output"),
                                            row.alias("row"))
        out = d if out is None else out.unionByName(d)
    return out


_R5_KEEP = {"Discharges/Total": ["bucket", "bucket_sort", "total_discharges"],
            "Patient Days": ["bucket", "patient_days", "implied_adc"], "Empty BP1 [future]": ["No data"]}


@_raw("r5_write_reports")
def _r5(spark, sf_dir):
    from careledger.reports import output_root, stamp_for, write_reports
    cat, p = bind_driver_tables(spark, sf_dir), test_params()
    reports = {"Discharges/Total": kpis.k06_discharges_total(cat, p), "Patient Days": kpis.k18_patient_days(cat, p),
               "Empty BP1 [future]": kpis.k17_bp1_detail(cat, FUTURE)}
    paths = write_reports(reports, f"{output_root(spark)}/r5-{uuid.uuid4().hex}", stamp_for(spark, p.end))
    return _flat(spark, paths, _R5_KEEP)


_R6_KEEP = {"window_admissions": ["result_set", "epi_slid", "admission_count"],
            "hold lines": ["li_slid", "lines_on_hold", "least", "most"]}


@_raw("r6_run_reports")
def _r6(spark, sf_dir):
    from careledger.reports import output_root, run_reports
    bind_driver_tables(spark, sf_dir).register_views()
    paths = run_reports(spark, test_params(), out_dir=f"{output_root(spark)}/r6-{uuid.uuid4().hex}",
                        definitions_path=None, folder=FIXTURE_SQL_DIR)
    return _flat(spark, paths, _R6_KEEP).drop("output")


@_raw("s5_script_folder_scan")
def _s5(spark, sf_dir):
    """Every script's extracted queries, and how many rows each returns on the tables."""
    from careledger.sources.scripts import definitions_from_folder
    bind_driver_tables(spark, sf_dir).register_views()
    defs = definitions_from_folder(spark, FIXTURE_SQL_DIR).collect()   # the catalog: a few names
    out = None
    for d in defs:
        for i, q in enumerate(d["query"]):
            r = spark.sql(q, args=test_params().sql_args()).agg(N().alias("rows")).select(
                F.lit(d["name"]).alias("name"), F.lit(i).alias("query_no"), F.lit(q).alias("query"), "rows")
            out = r if out is None else out.unionByName(r)
    return out


# Script corpus for T1-T3: the runner's own test inputs and crafted edge cases,
# unioned with every document of the corpus (whole texts).
SCRIPT_CASES = [
    ("case-simple", "SELECT * FROM dbo.SalesSummary"),
    ("case-delete", "DELETE FROM dbo.SalesSummary"),
    ("case-two", "SELECT * FROM A; SELECT * FROM B"),
    ("case-dynamic", "EXEC sp_executesql N'SELECT 1'"),
    ("case-multi", "\nUSE SampleDb\nDECLARE @AsOfDate date = CAST(GETDATE() AS date)\nSELECT @AsOfDate AS one;\nSELECT 2 AS two;\n"),
    ("case-paren", "(SELECT 1) ; (SELECT 2)"),
    ("case-spwho", "SELECT sp_who FROM t"),
    ("case-go", "SELECT 1\r\nGO\r\nselect x@EndDate from t /* c; */ -- x;\n"),
    ("case-external", "SELECT * FROM OPENROWSET('x')"),
    ("case-blank", "  \n "),
    ("case-with", "with a as (select 1 x) select * from a"),
    ("case-astral", "USE \U0001F600\U0001F600 SELECT 1 AS a"),
    ("case-many-setups", "USE a; SET b 1; SELECT 1; USE c SELECT 2; DECLARE @d int; SELECT 3; SELECT 4"),
]

_SCRIPTS_SQL = """
WITH scripts AS (
  SELECT * FROM (VALUES {cases}) AS c(script_id, text)
  UNION ALL SELECT 'doc-' || CAST(doc_id AS VARCHAR), text FROM documents)
"""


def _script_cases_sql():
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({q(i)}, {q(t)})" for i, t in SCRIPT_CASES)


def script_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.concat(F.lit("doc-"), C("doc_id").cast("string")).alias("script_id"), "text")
    return spark.createDataFrame(SCRIPT_CASES, "script_id string, text string").unionByName(docs)


WS = r"[\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _jstrim(x):
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


_STMTS_SQL = _SCRIPTS_SQL + f""",
cleaned AS (
  SELECT script_id, text,
    {_jstrim("replace(regexp_replace(regexp_replace(text, '/\\*[\\s\\S]*?\\*/', ' ', 'g'), '--[^\\n\\r\\x{2028}\\x{2029}]*', ' ', 'g'), chr(13), '{CR}')")} AS c
  FROM scripts),
pieces AS (
  SELECT script_id, list_filter(list_transform(regexp_split_to_array(c, '(?i);|\\bGO\\b'), lambda x: {_jstrim("x")}),
                                lambda x: x <> '') AS arr
  FROM cleaned),
stmts AS (
  SELECT script_id, i - 1 AS stmt_no, {_jstrim(f"regexp_replace(arr[i], '{WS}+', ' ', 'g')")} AS statement
  FROM pieces, range(1, len(arr) + 1) r(i))
"""


@_raw("t1_split_statements", _STMTS_SQL.replace("{CR}", "") + """
SELECT script_id, CAST(stmt_no AS INTEGER) AS stmt_no, statement FROM stmts
""", ["documents_view"])
def _t1(spark, sf_dir):
    return T.split_statements(script_corpus(spark, sf_dir))


_KIND = """
  CASE WHEN upper(split_part(statement, ' ', 1)) = 'GO' THEN 'skip'
       WHEN regexp_matches(statement, '(?i)\\b(?:EXEC|sp_executesql|xp_|sp_)\\b') THEN 'E:Dynamic SQL is not allowed.'
       WHEN regexp_matches(statement, '(?i)\\b(?:INSERT|UPDATE|DELETE|DROP|ALTER|TRUNCATE|MERGE|CREATE)\\b') THEN 'E:Only SELECT statements are allowed.'
       WHEN regexp_matches(statement, '(?i)\\b(?:OPENROWSET|OPENQUERY)\\b') THEN 'E:External rowset access is not allowed.'
       WHEN upper(split_part(statement, ' ', 1)) IN ('USE', 'SET') OR regexp_matches(statement, '(?i)^DECLARE\\b') THEN 'skip'
       WHEN regexp_matches(statement, '(?i)^(?:WITH|SELECT)\\b') THEN 'Q'
       WHEN regexp_matches(statement, '(?i)^\\(""" + WS + """*SELECT\\b') THEN 'P'
       ELSE 'E:Only SELECT statements are allowed.' END"""


@_raw("t2_audit_scripts", _STMTS_SQL.replace("{CR}", " ") + f""",
k AS (SELECT script_id, stmt_no, {_KIND} AS kind FROM stmts),
r AS (SELECT *, SUM(CASE WHEN kind IN ('Q', 'P') THEN 1 ELSE 0 END)
                  OVER (PARTITION BY script_id ORDER BY stmt_no ROWS UNBOUNDED PRECEDING) AS n FROM k),
f AS (SELECT *, CASE WHEN kind LIKE 'E:%' THEN substr(kind, 3)
                     WHEN kind = 'Q' AND n > 1 THEN 'Only a single statement is allowed.' END AS err FROM r),
s AS (SELECT script_id, arg_min(err, stmt_no) FILTER (WHERE err IS NOT NULL) AS first_err, MAX(n) AS total
      FROM f GROUP BY script_id),
res AS (
  SELECT sc.script_id,
         CASE WHEN {_jstrim("coalesce(sc.text, '')")} = '' THEN 'Query must be a non-empty string.'
              ELSE coalesce(s.first_err, CASE WHEN coalesce(s.total, 0) <> 1 THEN 'Only SELECT statements are allowed.' END)
         END AS error
  FROM scripts sc LEFT JOIN s ON s.script_id = sc.script_id)
SELECT script_id, error IS NULL AS valid, error FROM res
""", ["documents_view"])
def _t2(spark, sf_dir):
    return T.audit_scripts(script_corpus(spark, sf_dir))


@_raw("t3_extract_queries", _STMTS_SQL.replace("{CR}", "") + f""",
parts AS (
  SELECT script_id, stmt_no, statement,
         regexp_extract(statement, '(?i)^(.*?)\\b(?:WITH|SELECT)\\b', 1) AS pre,
         regexp_matches(statement, '(?i)\\b(?:WITH|SELECT)\\b') AS has_q
  FROM stmts),
p2 AS (
  SELECT script_id, stmt_no,
         CASE WHEN has_q THEN {_jstrim("pre")} ELSE statement END AS head,
         CASE WHEN has_q THEN {_jstrim("substr(statement, length(pre) + 1)")} END AS query
  FROM parts),
p3 AS (
  SELECT script_id, stmt_no, query,
         CASE WHEN head <> '' AND (upper(split_part(head, ' ', 1)) IN ('USE', 'SET') OR regexp_matches(head, '(?i)^DECLARE\\b'))
              THEN CASE WHEN regexp_matches(head, '(?i)^DECLARE\\b') THEN '-- ' || head ELSE head END END AS setup_line,
         query IS NOT NULL
           AND NOT regexp_matches(query, '(?i)\\b(?:EXEC|sp_executesql|xp_|sp_)\\b')
           AND NOT regexp_matches(query, '(?i)\\b(?:INSERT|UPDATE|DELETE|DROP|ALTER|TRUNCATE|MERGE|CREATE)\\b')
           AND NOT regexp_matches(query, '(?i)\\b(?:OPENROWSET|OPENQUERY)\\b')
           AND (regexp_matches(query, '(?i)^(?:WITH|SELECT)\\b') OR regexp_matches(query, '(?i)^\\({WS}*SELECT\\b')) AS ok
  FROM p2),
p4 AS (
  SELECT *, string_agg(setup_line, chr(10) ORDER BY stmt_no) OVER (PARTITION BY script_id ORDER BY stmt_no
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS setup
  FROM p3)
SELECT script_id, CAST(row_number() OVER (PARTITION BY script_id ORDER BY stmt_no) - 1 AS INTEGER) AS query_no,
       coalesce(setup, '') AS setup,
       concat_ws(chr(10), nullif(setup, ''),
                 CASE WHEN regexp_matches(query, '(?i)[A-Za-z0-9_]@(?:AsOfDate|EndDate|StartDate)\\b')
                      THEN 'DECLARE @AsOfDate date = CAST(GETDATE() AS date);' || chr(10) ||
                           'DECLARE @EndDate date = CAST(GETDATE() AS date);' || chr(10) ||
                           'DECLARE @StartDate date = DATEADD(day, -14, GETDATE());' END,
                 query) AS query
FROM p4 WHERE ok
""", ["documents_view"])
def _t3(spark, sf_dir):
    return T.extract_queries(script_corpus(spark, sf_dir))


_NAME_CASES = ["Sales/Report:Test[1]?", "", "   ", "a   b__c", "Revenue and RPD", "x" * 40]


@_raw("t4_sanitize_name", """
WITH names AS (SELECT * FROM (VALUES {cases}) AS c(name) UNION ALL SELECT url FROM pages),
b AS (SELECT name, coalesce(nullif(""" + _jstrim("coalesce(name, '')") + """, ''), 'Sheet1') AS base FROM names),
s AS (SELECT name, regexp_replace(regexp_replace(regexp_replace(base, '[\\\\/?*\\[\\]:]', '_', 'g'), '""" + WS + """+', ' ', 'g'), '_+', '_', 'g') AS s FROM b)
SELECT name, substr(""" + _jstrim("s") + """, 1, 31) AS sheet FROM s
""", ["pages_view"])
def _t4(spark, sf_dir):
    names = spark.createDataFrame([(n,) for n in _NAME_CASES], "name string").unionByName(
        spark.read.parquet(f"{sf_dir}/pages.parquet").select(C("url").alias("name")))
    return names.select("name", T.sanitize_name(C("name")).alias("sheet"))


@_raw("t5_report_stamp", """
SELECT CAST(o_orderdate AS DATE) AS run_date, 'KPIReport_' || strftime(o_orderdate, '%Y%m%d') AS stamp,
       'KPIReport_' || strftime(o_orderdate, '%Y%m%d') || '.xlsx' AS file_name, COUNT(*) AS orders
FROM orders GROUP BY 1, 2, 3
""", [])
def _t5(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("run_date"))
    return o.groupBy("run_date").agg(N().alias("orders")).select(
        "run_date", T.report_stamp("KPIReport", C("run_date")).alias("stamp"),
        T.report_stamp("KPIReport", C("run_date"), ".xlsx").alias("file_name"), "orders")


# ============================================================ registry
def _catalog_query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bind_driver_tables(spark, sf_dir), test_params())
    run.__name__ = getattr(fn, "__name__", "op")
    return run


OPERATOR_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{n: _catalog_query(f) for n, f in _SPARK.items()},
    **_RAW,
}


def _subst(sql: str) -> str:
    p = test_params()
    subs = {"S": f"DATE '{p.start}'", "E": f"DATE '{p.end}'", "A": f"DATE '{p.as_of}'",
            "E1": f"(DATE '{p.end}' + 1)", "cases": _script_cases_sql()}
    if "{cases}" in sql and "names AS" in sql:
        subs["cases"] = ", ".join("(" + ("'" + n.replace("'", "''") + "'") + ")" for n in _NAME_CASES)
    for k, v in subs.items():
        sql = sql.replace("{" + k + "}", v)
    return sql


def OPERATOR_ORACLES() -> dict[str, str]:
    out = {}
    for name, (body, tables) in _SQL.items():
        tables = [t for t in tables if not t.endswith("_view")]
        out[name] = _subst(with_tables(body, *tables) if tables else body.strip())
    # K06 is the first non-empty result set, so its columns are the header.
    k06, k07, k08 = (kpi_oracle_sql(n) for n in ("k06_discharges_total", "k07_discharges_by_class",
                                                  "k08_live_discharge_summary"))
    out["r3_stack_results"] = f"""
SELECT 0 AS result_set, bucket, bucket_sort, window_start, window_end, total_discharges FROM ({k06}) a
UNION ALL
SELECT 1, bucket, bucket_sort, NULL, NULL, NULL FROM ({k07}) b
UNION ALL
SELECT 2, bucket, bucket_sort, window_start, window_end, NULL FROM ({k08}) c"""
    # Three reports written and read back; the empty one holds the placeholder row.
    k18 = kpi_oracle_sql("k18_patient_days")

    def flat(report, output, columns, source):
        row = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
        return f"SELECT '{report}' AS report, '{output}' AS output, concat_ws('|', {row}) AS row FROM ({source})"

    out["r5_write_reports"] = " UNION ALL ".join([
        flat("Discharges/Total", "Discharges_Total", _R5_KEEP["Discharges/Total"], k06),
        flat("Patient Days", "Patient Days", _R5_KEEP["Patient Days"], k18),
        "SELECT 'Empty BP1 [future]', 'Empty BP1 _future_', 'No rows returned'"])
    # The fixture scripts' queries, written out for DuckDB.
    q = {k: _subst(with_tables(v, *_FIXTURE_TABLES[k])) for k, v in _FIXTURE_QUERIES.items()}
    out["s5_script_folder_scan"] = " UNION ALL ".join(
        f"SELECT '{name}' AS name, {no} AS query_no, '{text.replace(chr(39), chr(39) * 2)}' AS query, "
        f"(SELECT count(*) FROM ({q[k]})) AS rows" for k, (name, no, text) in _FIXTURE_TEXTS.items())
    first = f"SELECT 0 AS result_set, epi_slid, admission_count FROM ({q['adm0']}) UNION ALL " \
            f"SELECT 1, NULL, NULL FROM ({q['adm1']})"
    out["r6_run_reports"] = " UNION ALL ".join(
        f"SELECT report, row FROM ({flat(name, '', _R6_KEEP[name], source)})"
        for name, source in (("window_admissions", first), ("hold lines", q["holds"])))
    return out


# The queries of tests/fixtures/sql: as the extraction returns them, and as DuckDB SQL over the binding.
_FIXTURE_TEXTS = {
    "adm0": ("window_admissions", 0,
             "-- DECLARE @StartDate date = DATEADD(DAY, -14, GETDATE())\n-- DECLARE @EndDate date = GETDATE()\n"
             "SELECT epi_slid, COUNT(*) AS admission_count FROM episodes WHERE epi_status = 'CURRENT' AND epi_NonAdmitDate IS NULL "
             "AND CAST(epi_SocDate AS DATE) BETWEEN :start AND :end GROUP BY epi_slid"),
    "adm1": ("window_admissions", 1,
             "-- DECLARE @StartDate date = DATEADD(DAY, -14, GETDATE())\n-- DECLARE @EndDate date = GETDATE()\n"
             "SELECT epi_AdmitType, COUNT(*) AS admissions_all_types FROM episodes "
             "WHERE CAST(epi_SocDate AS DATE) BETWEEN :start AND :end GROUP BY epi_AdmitType"),
    "holds": ("hold lines", 0,
              "SELECT li_slid, count(*) AS lines_on_hold, min(li_servicedate) AS least, max(li_servicedate) AS most FROM line_items "
              "WHERE li_ediexportdate IS NULL AND li_servicedate >= :start AND li_servicedate <= :end GROUP BY li_slid"),
}
_FIXTURE_QUERIES = {
    "adm0": """SELECT epi_slid, COUNT(*) AS admission_count FROM episodes
WHERE epi_status = 'CURRENT' AND epi_NonAdmitDate IS NULL AND CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E}
GROUP BY epi_slid""",
    "adm1": """SELECT epi_AdmitType, COUNT(*) AS admissions_all_types FROM episodes
WHERE CAST(epi_SocDate AS DATE) BETWEEN {S} AND {E} GROUP BY epi_AdmitType""",
    "holds": """SELECT li_slid, count(*) AS lines_on_hold, min(li_servicedate) AS least, max(li_servicedate) AS most
FROM line_items WHERE li_ediexportdate IS NULL AND li_servicedate BETWEEN {S} AND {E} GROUP BY li_slid""",
}
_FIXTURE_TABLES = {"adm0": ["episodes"], "adm1": ["episodes"], "holds": ["line_items"]}
