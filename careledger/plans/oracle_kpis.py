"""Oracle SQL for K01-K30 (DuckDB), stated from the report definitions of SURVEY 2.9.

Every statement reads one of two shared frames: ``placed`` (each episode with
the branch that its service line and code name) or ``coded`` (amounts summed per
branch code, then labelled).  Conditions are ``FILTER`` clauses of one aggregate,
one-to-many tables are counted per key and multiplied out, single figures are
scalar subqueries.  Strings compare without trailing blanks (right-trimmed on
both sides); integer sums are cast back to BIGINT.
"""

from __future__ import annotations

from careledger.params import test_params, test_params_90
from careledger.plans.oracle_tables import with_tables

NO_BUCKET = "coalesce(bucket, '(unmapped)')"
WINDOW = "{S} AS window_start, {E} AS window_end"
YES = "('Y', '1', 'R', 'RECERT', 'TRUE')"


def is_(column: str, *values: str) -> str:
    return f"rtrim({column}) IN ({', '.join(repr(v) for v in values)})"


def not_(column: str, value: str) -> str:
    return f"rtrim({column}) <> '{value}'"


def during(column: str) -> str:
    """The window's days, the last one whole."""
    return f"({column} >= {{S}} AND {column} < {{E1}})"


def alive(day: str) -> str:
    return f"(epi_SocDate <= {day} AND coalesce(epi_DischargeDate > {day}, true))"


def percent(part: str, whole: str, kind: str) -> str:
    return f"CAST({part} * 100.0 / nullif({whole}, 0) AS {kind})"


def placed(dim: str = "dim_branch", wildcard: bool = False, source: str = "episodes", line: str = "epi_slid") -> str:
    """CTEs ``branch`` and ``placed``; with ``wildcard`` a branch without a code takes its whole line."""
    code = "CASE WHEN branch.code IS NOT NULL THEN rtrim(x.epi_branchcode) END" if wildcard else "rtrim(x.epi_branchcode)"
    test = f"branch.code IS NOT DISTINCT FROM {code}" if wildcard else f"branch.code = {code}"
    return f"""
branch AS (
  SELECT epi_slid AS line, rtrim(epi_branchcode) AS code, branch_name AS bucket, rtrim(service_line) AS kind FROM {dim}),
placed AS (
  SELECT x.*, branch.bucket, branch.kind,
         CASE branch.kind WHEN 'HOME HEALTH' THEN 1 WHEN 'HOSPICE' THEN 2 ELSE 99 END AS place
  FROM {source} x LEFT JOIN branch ON branch.line = x.{line} AND {test})"""


def per_bucket(columns: str, where: str, label: str = "bucket", place: str = "bucket_sort", group: str = "bucket",
               fixed: str = WINDOW, ctes: str = "") -> str:
    return f"""WITH {ctes or placed()}
SELECT {NO_BUCKET} AS {label}, min(place) AS {place}, {fixed + ',' if fixed else ''} {columns}
FROM placed WHERE {where} GROUP BY {group}"""


def coded(columns: str, totals: str, where: str, source: str, label: str, fixed: str = WINDOW) -> str:
    """Totals per branch code, then the code's branches beside them."""
    return f"""WITH totals AS (SELECT code, {totals} FROM ({source}) s WHERE {where} GROUP BY code)
SELECT {label} AS bucket,
       CASE rtrim(service_line) WHEN 'HOME HEALTH' THEN 1 WHEN 'HOSPICE' THEN 2 ELSE 99 END AS bucket_sort,
       code AS branch_code, {fixed}, {columns}
FROM totals LEFT JOIN dim_branch ON rtrim(epi_branchcode) = code"""


NAME_OR_CODE = "coalesce(branch_name, nullif(trim(code), ''), '(no branch)')"
NAME_ONLY = "coalesce(branch_name, '(unmapped)')"
NEW = f"{is_('epi_status', 'CURRENT')} AND {is_('epi_AdmitType', 'NEW ADMISSION')} AND epi_NonAdmitDate IS NULL"
ADMITTED = f"{not_('epi_status', 'DELETED')} AND epi_NonAdmitDate IS NULL"
CLAIMED = "li_deleted + li_void = 0 AND li_includeonclaim = 1"
CLASS = "coalesce((SELECT max(dc_class) FROM dc_class WHERE rtrim(dr_code) = rtrim(epi_DcCode)), 'Other')"
STAY = "date_diff('day', epi_SocDate, epi_DischargeDate)"
RECERT = f"coalesce(upper(trim(epi_RecertFlag)) IN {YES}, false)"
BIG = "CAST({} AS BIGINT)".format

# ``days``: a stay's days inside the window, none below zero.
STAY_DAYS = """greatest(0, date_diff('day', greatest(epi_SocDate, CAST({S} AS TIMESTAMP)),
       CASE WHEN epi_DischargeDate <= {E} THEN epi_DischargeDate ELSE CAST({E1} AS TIMESTAMP) END))"""
IN_STAY = f"{ADMITTED} AND epi_SocDate <= {{E}} AND coalesce(epi_DischargeDate > {{S}}, true)"

PERIODS = """periods AS (
  SELECT pp_id, pp_startDate, pp_endDate, pp_reimbursementType, pp_currentHipps, cefs_epiid AS episode
  FROM pdgm_period JOIN episode_fs ON cefs_id = pp_cefsId
  WHERE pp_deleted = 0 AND pp_periodEnded = 1 AND pp_endDate >= {S} AND pp_endDate <= {E})"""


def lupa(test: str) -> str:
    return f"""WITH {placed()},
{PERIODS}
SELECT {NO_BUCKET} AS bucket, min(place) AS bucket_sort, {WINDOW},
       count(*) FILTER (WHERE {test}) AS lupa_periods, count(*) AS total_periods,
       CAST(count(*) FILTER (WHERE {test}) * 100.0 / count(*) AS DECIMAL(6,2)) AS lupa_pct
FROM periods JOIN placed ON epi_id = episode WHERE {not_('epi_status', 'DELETED')} GROUP BY bucket"""


def referrals(ctes: str) -> str:
    came, left = during("epi_DateOfReferral"), during("epi_NonAdmitDate")
    began = f"({during('epi_SocDate')} AND epi_NonAdmitDate IS NULL)"
    count = "count(*) FILTER (WHERE {})".format
    share = lambda what: f"CAST(CASE WHEN {count(came)} > 0 THEN {count(what)} * 100.0 / {count(came)} END AS DECIMAL(5,1))"
    return per_bucket(f"{count(came)} AS referrals, {count(began)} AS admissions, {count(left)} AS non_admits, "
                      f"{share(left)} AS ntuc_pct, {share(began)} AS conversion_pct",
                      f"{not_('epi_status', 'DELETED')} AND ({came} OR {began} OR {left})", ctes=ctes)


def reasons(ctes: str, table: str) -> str:
    return f"""WITH {ctes},
reason AS ({table})
SELECT {NO_BUCKET} AS bucket, min(place) AS bucket_sort, {WINDOW}, rtrim(epi_NonAdmitCode) AS nonadmit_code,
       coalesce(reason.text, '(unknown reason)') AS nonadmit_reason, reason.refused AS refusal_of_service,
       count(*) AS non_admit_count
FROM placed LEFT JOIN reason ON reason.code = rtrim(epi_NonAdmitCode)
WHERE {not_('epi_status', 'DELETED')} AND {during('epi_NonAdmitDate')}
GROUP BY bucket, rtrim(epi_NonAdmitCode), reason.text, reason.refused"""


FIRST_VISIT = """stays AS (
  SELECT epi_id, epi_SocDate, (SELECT min(cev_visitdate) FROM visits
                               WHERE cev_epiid = epi_id AND rtrim(cev_setsocdateflag) = 'Y') AS bp1_date
  FROM episodes WHERE {ADMITTED} AND {SOC})""".replace("{ADMITTED}", ADMITTED).replace("{SOC}", during("epi_SocDate"))
HOURS = "date_diff('hour', epi_SocDate, bp1_date)"

EQUIVALENT = f"{not_('epi_status', 'CURRENT')} AND epi_NonAdmitDate IS NULL AND {alive('{A}')}"
FACTOR = "CAST(0.400 AS DECIMAL(5,3))"
HELD = f"(SELECT count(*) FROM placed WHERE {EQUIVALENT} AND kind = '{{kind}}')"
HH, HOS = HELD.replace("{kind}", "HOME HEALTH"), HELD.replace("{kind}", "HOSPICE")

REVENUE_SOURCE = f"""(
  SELECT li_calculatedamount, li_slid, (SELECT max(epi_branchcode) FROM episodes
         WHERE epi_id = li_epiid AND {not_('epi_status', 'DELETED')}) AS epi_branchcode
  FROM line_items WHERE {CLAIMED} AND li_servicedate >= {{S}} AND li_servicedate <= {{E}})"""
REVENUE = placed(source=REVENUE_SOURCE, line="li_slid")

LINE_CODE = """SELECT li.*, i.i_status, rtrim(coalesce(i.i_branchcode, e.epi_branchcode)) AS code
  FROM line_items li LEFT JOIN invoices i ON i.i_id = li.li_iid LEFT JOIN episodes e ON e.epi_id = li.li_epiid"""
INVOICE_CODE = "SELECT *, rtrim(i_branchcode) AS code, date_diff('day', i_postdate, {A}) AS age FROM invoices"
CLEARED = "li_ediexportdate IS NOT NULL AND CAST(li_ediexportdate AS DATE) <= {SLA}"
MONEY = "CAST({} AS DECIMAL(28,2))".format


def aged(name: str, test: str) -> str:
    return f"coalesce(sum(i_balance) FILTER (WHERE {test}), 0) AS {name}"


# Rows that stand for one episode in K19: its face-to-face (all, active), certification and recert rows.
QA = f"""{placed()},
counted AS (
  SELECT bucket, place, {RECERT} AS wants,
         (SELECT count(*) FROM facetoface WHERE ceftf_f2fappliestoepiid = epi_id) AS f,
         (SELECT count(*) FROM facetoface WHERE ceftf_f2fappliestoepiid = epi_id AND ceftf_active = 1) AS active,
         (SELECT count(*) FROM admission_types WHERE ceat_epiid = epi_id) AS c,
         (SELECT count(*) FROM recert_history WHERE cerh_epiid = epi_id) AS r
  FROM placed WHERE {ADMITTED} AND {during('epi_SocDate')}),
weighed AS (
  SELECT *, greatest(f, 1) AS wf, greatest(c, 1) AS wc, greatest(r, 1) AS wr FROM counted)"""

K: dict[str, tuple[str, list[str]]] = {
    "k01_admissions_by_branch": (per_bucket(
        "count(*) AS admission_count", f"{NEW} AND {during('epi_SocDate')}", "service_line", "service_line_id",
        ctes=placed(wildcard=True)), ["episodes", "dim_branch"]),
    "k02_admissions_by_care_type": (f"""WITH {placed(wildcard=True)},
kinds AS (
  SELECT cect_epiid AS episode, coalesce(ctype_description, '(no primary care type)') AS care_type, count(*) AS n
  FROM episode_care_types LEFT JOIN care_types ON ctype_id = cect_ctypeid WHERE {is_('cect_primary', 'Y')} GROUP BY ALL)
SELECT bucket AS service_line, min(place) AS service_line_id, coalesce(care_type, '(no primary care type)') AS care_type,
       {WINDOW}, {BIG('sum(coalesce(n, 1))')} AS admission_count
FROM placed LEFT JOIN kinds ON episode = epi_id
WHERE kind = 'HOME HEALTH' AND epi_slid IN (SELECT sl_id FROM service_lines) AND {NEW} AND {during('epi_SocDate')}
GROUP BY bucket, coalesce(care_type, '(no primary care type)')""",
        ["episodes", "dim_branch", "service_lines", "episode_care_types", "care_types"]),
    "k03_days_to_admit": (per_bucket(
        "count(*) AS admissions, CAST(avg(date_diff('day', epi_DateOfReferral, epi_SocDate)) AS DECIMAL(10,2)) AS avg_days_to_admit, "
        + percent("count(*) FILTER (WHERE date_diff('day', epi_DateOfReferral, epi_SocDate) <= 2)", "count(*)", "DECIMAL(5,2)")
        + " AS pct_within_2_days",
        f"{NEW} AND {during('epi_SocDate')} AND date_diff('day', epi_DateOfReferral, epi_SocDate) >= 0",
        "branch", "service_line"), ["episodes", "dim_branch"]),
    "k04_billing_holds_sla": (coded(
        f"held AS total_holds, cleared AS cleared_by_sla, {percent('cleared', 'held', 'DECIMAL(5,1)')} AS pct_cleared_by_sla, "
        f"{MONEY('amount')} AS total_hold_amount, {MONEY('coalesce(cleared_sum, 0)')} AS cleared_amount",
        f"count(*) AS held, count(*) FILTER (WHERE {CLEARED}) AS cleared, sum(li_calculatedamount) AS amount, "
        f"sum(li_calculatedamount) FILTER (WHERE {CLEARED}) AS cleared_sum",
        f"{CLAIMED} AND {during('li_servicedate')} AND (li_ediexportdate IS NULL OR {is_('i_status', 'HOLD', 'HELD')})",
        LINE_CODE, NAME_OR_CODE, WINDOW + ", {SLA} AS sla_cutoff_date"),
        ["line_items", "invoices", "episodes", "dim_branch"]),
    "k05_daily_census": (f"""WITH days AS (SELECT CAST(unnest(generate_series({{S}}, {{E}}, INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day AS CensusDate, sl_desc, branch_name, count(DISTINCT epi_paid) AS DailyCensus
FROM episodes, days, service_lines, branches
WHERE {is_('epi_status', 'CURRENT')} AND {alive('day')} AND sl_id = epi_slid AND rtrim(branch_code) = rtrim(epi_branchcode)
GROUP BY ALL""", ["episodes", "service_lines", "branches"]),
    "k06_discharges_total": (per_bucket(
        "count(*) AS total_discharges", f"{not_('epi_status', 'DISCHARGED')} AND {during('epi_DischargeDate')}"),
        ["episodes", "dim_branch"]),
    "k07_discharges_by_class": (per_bucket(
        f"{CLASS} AS dc_class, count(*) AS discharges, count(DISTINCT rtrim(epi_DcCode)) AS distinct_dc_codes",
        f"{is_('epi_status', 'DISCHARGED')} AND {during('epi_DischargeDate')}", group="bucket, 3", fixed=""),
        ["episodes", "dim_branch", "dc_class"]),
    "k08_live_discharge_summary": (f"""WITH {placed()},
gone AS (SELECT *, {CLASS} AS how FROM placed WHERE {not_('epi_status', 'DISCHARGED')} AND {during('epi_DischargeDate')})
SELECT {NO_BUCKET} AS bucket, min(place) AS bucket_sort, {WINDOW},
       count(*) FILTER (WHERE how = 'LiveDC-PatientInitiated') AS live_dc_patient_initiated,
       count(*) FILTER (WHERE how = 'LiveDC-HospiceInitiated') AS live_dc_hospice_initiated,
       count(*) FILTER (WHERE how LIKE 'LiveDC-%') AS live_dc_total,
       count(*) FILTER (WHERE how = 'Death') AS deaths, count(*) FILTER (WHERE how = 'Other') AS other_or_unmapped
FROM gone GROUP BY bucket""", ["episodes", "dim_branch", "dc_class"]),
    "k09_hce_by_branch": (f"""WITH {placed()}
SELECT bucket, kind AS service_line, {{A}} AS as_of_date, {FACTOR} AS hce_factor, count(*) AS raw_census,
       CAST(CASE kind WHEN 'HOME HEALTH' THEN count(*) * {FACTOR} ELSE count(*) END AS DECIMAL(10,2)) AS hce_value
FROM placed WHERE {EQUIVALENT} GROUP BY bucket, kind""", ["episodes", "dim_branch"]),
    "k10_hce_combined": (f"""WITH {placed()}
SELECT 'HH+Palliative' AS bucket, {{A}} AS as_of_date, {FACTOR} AS hce_factor, nullif({HH}, 0) AS raw_hh_pal_census,
       CAST(nullif({HH}, 0) * {FACTOR} AS DECIMAL(10,2)) AS hce_value""", ["episodes", "dim_branch"]),
    "k11_hce_total": (f"""WITH {placed()}
SELECT 'ALL LOCATIONS' AS bucket, {{A}} AS as_of_date, {FACTOR} AS hce_factor, {HH} AS raw_hh_pal_census,
       {HOS} AS raw_hospice_census, CAST({HOS} + {HH} * {FACTOR} AS DECIMAL(10,2)) AS total_hce""", ["episodes", "dim_branch"]),
    "k12_los_discharged": (per_bucket(
        f"count(*) AS discharged_episodes, CAST(avg({STAY}) AS DECIMAL(10,1)) AS avg_los_days, "
        f"CAST(quantile_cont({STAY}, 0.5) AS DECIMAL(10,1)) AS median_los_days, 100 AS median_los_benchmark",
        f"{ADMITTED} AND {during('epi_DischargeDate')}"), ["episodes", "dim_branch"]),
    "k13_los_active": (per_bucket(
        "count(*) AS active_census, CAST(avg(date_diff('day', epi_SocDate, {A})) AS DECIMAL(10,1)) AS avg_current_los_days",
        f"{ADMITTED} AND {alive('{A}')}", fixed="{A} AS as_of_date"), ["episodes", "dim_branch"]),
    "k14_lupa_by_reimbursement": (lupa("trim(pp_reimbursementType) IN (SELECT code FROM lupa_codes)"),
                                  ["pdgm_period", "episode_fs", "episodes", "dim_branch", "lupa_codes"]),
    "k15_lupa_by_threshold": (lupa(
        """(SELECT count(*) FROM visits_all WHERE cev_epiid = episode AND cev_deleted = 0 AND cev_billable = 1
            AND CAST(cev_visitdate AS DATE) >= pp_startDate AND CAST(cev_visitdate AS DATE) <= pp_endDate)
           < (SELECT max(ph_lupaThreshold) FROM pdgm_hipps WHERE rtrim(ph_hipps) = trim(pp_currentHipps))"""),
        ["pdgm_period", "episode_fs", "episodes", "visits_all", "pdgm_hipps", "dim_branch"]),
    "k16_bp1_summary": (f"""WITH {FIRST_VISIT},
tally AS (SELECT count(*) AS n, count(*) FILTER (WHERE {HOURS} <= 48) AS fast FROM stays)
SELECT n AS total_admissions, CASE WHEN n > 0 THEN fast END AS bp1_compliant,
       CAST(round(fast * 100.0 / nullif(n, 0), 2) AS DECIMAL(10,2)) AS bp1_compliance_percent,
       if(fast * 100 >= 80 * nullif(n, 0), '✅ Meets KPI (>=80%)', '❌ Below KPI') AS kpi_status
FROM tally""", ["episodes", "visits"]),
    "k17_bp1_detail": (f"""WITH {FIRST_VISIT}
SELECT epi_id, epi_SocDate, bp1_date, CAST({HOURS} AS INTEGER) AS hours_to_bp1,
       coalesce(if({HOURS} <= 48, 'Compliant', if(bp1_date IS NULL, NULL, 'Late')), 'No BP1') AS bp1_status
FROM stays""", ["episodes", "visits"]),
    "k18_patient_days": (per_bucket(
        f"{BIG(f'sum({STAY_DAYS})')} AS patient_days, {{DAYS}} AS days_in_window, "
        f"CAST(sum({STAY_DAYS}) * 1.0 / {{DAYS}} AS DECIMAL(10,2)) AS implied_adc", IN_STAY), ["episodes", "dim_branch"]),
    "k19_qa_compliance": (f"""WITH {QA}
SELECT bucket, min(place) AS bucket_sort, {WINDOW}, {BIG('sum(wf * wc * wr)')} AS total_episodes,
       {BIG('sum(active * wc * wr)')} AS f2f_compliant, {BIG('sum(c * wf * wr)')} AS cert_compliant,
       {BIG('coalesce(sum(wf * wc * wr) FILTER (WHERE NOT wants OR r > 0), 0)')} AS recert_compliant,
       {BIG('sum(active * c * if(wants, r, wr))')} AS compliant_episodes,
       {percent('sum(active * c * if(wants, r, wr))', 'sum(wf * wc * wr)', 'DECIMAL(5,1)')} AS qa_compliance_pct
FROM weighed GROUP BY bucket""", ["episodes", "dim_branch", "facetoface", "admission_types", "recert_history"]),
    "k20_recert_rate": (per_bucket(
        f"count(*) FILTER (WHERE {RECERT}) AS recert_count, count(*) AS total_cert_count, "
        f"{percent(f'count(*) FILTER (WHERE {RECERT})', 'count(*)', 'DECIMAL(5,1)')} AS recert_pct",
        f"{not_('epi_status', 'RECERTIFIED')} AND epi_NonAdmitDate IS NULL AND {during('epi_SocDate')}"),
        ["episodes", "dim_branch"]),
    "k21_recert_share_of_episodes": (per_bucket(
        f"count(*) FILTER (WHERE {RECERT} AND {during('epi_SocDate')}) AS recert_count, count(*) AS total_episode_count, "
        + percent(f"count(*) FILTER (WHERE {RECERT} AND {during('epi_SocDate')})", "count(*)", "DECIMAL(5,1)")
        + " AS recert_pct_of_episodes",
        f"{not_('epi_status', 'RECERTIFIED')} AND epi_NonAdmitDate IS NULL AND epi_SocDate < {{E1}} "
        "AND coalesce(epi_DischargeDate >= {S}, true)"), ["episodes", "dim_branch"]),
    "k22_referral_conversion_strict": (referrals(placed("dim_branch_17")), ["episodes", "dim_branch_17"]),
    "k23_nonadmit_reasons_dedup": (reasons(
        placed("dim_branch_17"),
        "SELECT rtrim(nac_code) AS code, min(nac_desc) AS text, bool_or(nac_refusalofservice) AS refused FROM nonadmit_reasons GROUP BY 1"),
        ["episodes", "dim_branch_17", "nonadmit_reasons"]),
    "k24_referral_conversion": (referrals(placed(wildcard=True)), ["episodes", "dim_branch"]),
    "k25_nonadmit_reasons_raw": (reasons(
        placed(wildcard=True),
        "SELECT rtrim(nac_code) AS code, nac_desc AS text, nac_refusalofservice AS refused FROM nonadmit_reasons"),
        ["episodes", "dim_branch", "nonadmit_reasons"]),
    "k26_revenue_by_branch": (per_bucket("CAST(sum(li_calculatedamount) AS DECIMAL(18,2)) AS revenue", "true", ctes=REVENUE),
                              ["line_items", "episodes", "dim_branch"]),
    # Rows without a bucket stay apart by their side: NULL never equals NULL.
    "k27_revenue_per_patient_day": (f"""WITH {placed()},
earned AS ({per_bucket('sum(li_calculatedamount) AS money', 'true', fixed='', ctes=REVENUE)}),
sides AS (
  SELECT bucket, bucket_sort, money, NULL AS days, 1 AS side FROM earned
  UNION ALL
  SELECT {NO_BUCKET}, min(place), NULL, sum({STAY_DAYS}), 2 FROM placed WHERE {IN_STAY} GROUP BY bucket)
SELECT bucket, min(bucket_sort) AS bucket_sort, {WINDOW}, CAST(coalesce(sum(money), 0) AS DECIMAL(18,2)) AS revenue,
       {BIG('coalesce(sum(days), 0)')} AS patient_days,
       CAST(CASE WHEN sum(days) > 0 THEN coalesce(sum(money), 0) * 1.0 / sum(days) END AS DECIMAL(18,2)) AS revenue_per_patient_day
FROM sides GROUP BY bucket, CASE bucket WHEN '(unmapped)' THEN side END""", ["line_items", "episodes", "dim_branch"]),
    "k28_ar_aging": (coded(
        ", ".join(f"{MONEY(c)} AS {c}" for c in ("ar_0_30", "ar_31_60", "ar_61_90", "ar_over_90", "ar_total")),
        ", ".join([aged("ar_0_30", "age <= 30"), aged("ar_31_60", "age > 30 AND age <= 60"), aged("ar_61_90", "age > 60 AND age <= 90"),
                   aged("ar_over_90", "age > 90"), "sum(i_balance) AS ar_total"]),
        "i_balance > 0 AND i_postdate <= {A}", INVOICE_CODE, NAME_OR_CODE), ["invoices", "dim_branch"]),
    "k29_ar_over_90": (coded(
        f"old AS invoices_over_90, {MONEY('owed')} AS ar_over_90", "count(*) AS old, sum(i_balance) AS owed",
        "i_balance > 0 AND age > 90", INVOICE_CODE, NAME_ONLY), ["invoices", "dim_branch"]),
    "k30_unbilled": (coded(
        f"n AS unbilled_line_items, {MONEY('coalesce(amount, 0)')} AS unbilled_amount",
        "count(*) AS n, sum(li_calculatedamount) AS amount",
        f"{CLAIMED} AND li_ediexportdate IS NULL AND li_iid IS NULL", LINE_CODE, NAME_ONLY),
        ["line_items", "invoices", "episodes", "dim_branch"]),
}


def kpi_oracle_sql(name: str, params=None) -> str:
    from careledger.plans.kpis import WIDE_WINDOW
    if params is None:
        params = test_params_90() if name in WIDE_WINDOW else test_params()
    body, tables = K[name]
    sql = with_tables(body, *tables)
    for key, value in {"SLA": f"DATE '{params.sla_cutoff}'", "E1": f"(DATE '{params.end}' + 1)", "S": f"DATE '{params.start}'",
                       "E": f"DATE '{params.end}'", "A": f"DATE '{params.as_of}'", "DAYS": str(params.days_in_window)}.items():
        sql = sql.replace("{" + key + "}", value)
    return sql
