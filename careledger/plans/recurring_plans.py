"""Plans for what recurring runs add to the reports: layouts whose windows prune files, census steps, binned ranges,
selected percentiles, stored distinct days, published runs.

Each entry works on the whole bound tables; its oracle states the same result
without the mechanism.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.functions.columns import days_between
from careledger.functions.predicates import in_window_by_date, in_window_half_open, in_window_raw
from careledger.operators.branching import with_bucket
from careledger.operators.census import daily_census
from careledger.operators.ranges import count_in_ranges
from careledger.operators.selection import exact_median, exact_percentile
from careledger.params import RunParams, test_params
from careledger.plans import kpis
from careledger.plans.oracle_kpis import kpi_oracle_sql
from careledger.plans.oracle_tables import with_tables
from careledger.reports import output_root, run_query, write_reports
from careledger.runs import published
from careledger.sources.catalog import Catalog
from careledger.sources.clustered import materialize_clustered, within
from careledger.sources.collation import collated
from careledger.sources.distinct_days import DistinctDays
from careledger.sources.driver_tables import bind_driver_tables

C = F.col
DECADE = (dt.date(1992, 1, 1), dt.date(2001, 12, 31))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, tuple[str, list[str]] | str] = {}


def plan(name: str, sql: str, tables: list[str] | None = None):
    """Register ``fn(catalog, params)``; ``sql`` is a statement over ``tables``, or the name of a report with the same rows."""
    def deco(fn: Callable[[Catalog, RunParams], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(bind_driver_tables(spark, sf_dir), test_params())
        _SQL[name] = sql if tables is None else (sql, tables)
        return fn
    return deco


def oracles() -> dict[str, str]:
    p = test_params()
    dates = {"{S}": f"DATE '{p.start}'", "{E}": f"DATE '{p.end}'", "{D0}": f"DATE '{DECADE[0]}'", "{D1}": f"DATE '{DECADE[1]}'"}
    out = {}
    for name, stated in _SQL.items():
        text = kpi_oracle_sql(stated) if isinstance(stated, str) else with_tables(*[stated[0], *stated[1]])
        for mark, day in dates.items():
            text = text.replace(mark, day)
        out[name] = text
    return out


def _folder(cat: Catalog, tag: str) -> str:
    return f"{output_root(cat.spark)}/{tag}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- S1, P7-P11: windows that prune files
@plan("s1_clustered_windows", """
SELECT 'line_items' AS source, count(*) AS n, min(CAST(li_servicedate AS DATE)) AS least, max(CAST(li_servicedate AS DATE)) AS most
FROM line_items WHERE CAST(li_servicedate AS DATE) BETWEEN {S} AND {E}
UNION ALL SELECT 'visits', count(*), min(CAST(cev_visitdate AS DATE)), max(CAST(cev_visitdate AS DATE))
FROM visits_all WHERE cev_visitdate >= {S} AND cev_visitdate < {E} + INTERVAL 1 DAY
UNION ALL SELECT 'invoices', count(*), min(CAST(i_postdate AS DATE)), max(CAST(i_postdate AS DATE))
FROM invoices WHERE i_postdate BETWEEN {S} AND {E}
""", ["line_items", "visits_all", "invoices"])
def s1_clustered_windows(cat: Catalog, p: RunParams) -> DataFrame:
    """The three closed windows (P7, P9, P8) on tables clustered by month."""
    c = materialize_clustered(cat, _folder(cat, "clustered"), tables=["line_items", "visits_all", "invoices"])

    def seen(source: str, df: DataFrame, column: str, test) -> DataFrame:
        day = F.to_date(column)
        return within(df, column, p.start, p.end).filter(test(C(column), p.start, p.end)).agg(
            F.count(F.lit(1)).alias("n"), F.min(day).alias("least"), F.max(day).alias("most")).select(
            F.lit(source).alias("source"), "n", "least", "most")

    return (seen("line_items", c.line_items, "li_servicedate", in_window_by_date)
            .unionByName(seen("visits", c.visits_all, "cev_visitdate", in_window_half_open))
            .unionByName(seen("invoices", c.invoices, "i_postdate", in_window_raw)))


@plan("p8_revenue_by_clustered_day", "k26_revenue_by_branch")
def p8_revenue_by_clustered_day(cat: Catalog, p: RunParams) -> DataFrame:
    """K26 on line items that are clustered by day."""
    return kpis.k26_revenue_by_branch(
        materialize_clustered(cat, _folder(cat, "clustered"), "day", ["line_items"]), p)


@plan("p10_open_stays", "k13_los_active")
def p10_open_stays(cat: Catalog, p: RunParams) -> DataFrame:
    """K13 on open stays and stays closed in the as-of month or later."""
    return kpis.k13_los_active(materialize_clustered(cat, _folder(cat, "clustered"), tables=["episodes"]), p)


@plan("p11_overlapping_stays", "k18_patient_days")
def p11_overlapping_stays(cat: Catalog, p: RunParams) -> DataFrame:
    return kpis.k18_patient_days(materialize_clustered(cat, _folder(cat, "clustered"), tables=["episodes"]), p)


# ---------------------------------------------------------------- J7, J8: ranges without products
@plan("j7_census_steps", """
WITH days AS (SELECT CAST(unnest(generate_series({D0}, {D1}, INTERVAL 1 DAY)) AS DATE) AS day)
SELECT day AS CensusDate, epi_slid, count(DISTINCT epi_paid) AS DailyCensus
FROM episodes, days WHERE epi_SocDate <= day AND (epi_DischargeDate IS NULL OR epi_DischargeDate > day) GROUP BY ALL
""", ["episodes"])
def j7_census_steps(cat: Catalog, p: RunParams) -> DataFrame:
    """Ten years of daily census, in rows as many as stays."""
    return daily_census(cat.episodes, ["epi_slid"], "epi_paid", *DECADE)


@plan("j8_binned_ranges", """
SELECT visits, count(*) AS periods FROM (
  SELECT pp.pp_id, count(v.cev_id) AS visits FROM pdgm_period pp JOIN episode_fs fs ON fs.cefs_id = pp.pp_cefsId
  LEFT JOIN visits_all v ON v.cev_epiid = fs.cefs_epiid AND CAST(v.cev_visitdate AS DATE) BETWEEN pp.pp_startDate AND pp.pp_endDate
  GROUP BY pp.pp_id) GROUP BY visits
""", ["pdgm_period", "episode_fs", "visits_all"])
def j8_binned_ranges(cat: Catalog, p: RunParams) -> DataFrame:
    """Visits of all periods, whatever their dates."""
    periods = cat.pdgm_period.join(cat.episode_fs, C("cefs_id") == C("pp_cefsId")).select(
        C("pp_id").alias("id"), C("cefs_epiid").alias("key"), C("pp_startDate").alias("first"), C("pp_endDate").alias("last"))
    counts = count_in_ranges(cat.visits_all.select(C("cev_epiid").alias("key"), F.to_date("cev_visitdate").alias("day")), periods)
    return (periods.select("id").join(counts, "id", "left").groupBy(F.coalesce("n", F.lit(0)).alias("visits"))
            .agg(F.count(F.lit(1)).alias("periods")))


# ---------------------------------------------------------------- A19, W1: percentiles of continuous measures
@plan("a19_selected_median", """
WITH r AS (SELECT li_slid, li_calculatedamount AS v, count(*) OVER (PARTITION BY li_slid) AS n,
                  row_number() OVER (PARTITION BY li_slid ORDER BY li_calculatedamount) - 1 AS k FROM line_items)
SELECT li_slid, CAST((max(v) FILTER (k = (n - 1) // 2) + max(v) FILTER (k = n // 2)) / 2 AS DECIMAL(20,3)) AS median_amount
FROM r GROUP BY li_slid
""", ["line_items"])
def a19_selected_median(cat: Catalog, p: RunParams) -> DataFrame:
    """The median amount of each line's items: two groups, nearly all values different."""
    return exact_median(cat.line_items, ["li_slid"], "li_calculatedamount").select(
        "li_slid", C("median").cast("decimal(20,3)").alias("median_amount"))


@plan("w1_selected_percentile", """
WITH r AS (SELECT i_status, i_balance AS v, count(*) OVER (PARTITION BY i_status) AS n,
                  row_number() OVER (PARTITION BY i_status ORDER BY i_balance) - 1 AS k FROM invoices),
q AS (SELECT i_status, max(v) FILTER (k = (n - 1) * 9 // 10) AS a, max(v) FILTER (k = ((n - 1) * 9 + 9) // 10) AS b,
             max((n - 1) * 9 % 10) AS tenths FROM r GROUP BY i_status),
p AS (SELECT i_status, CAST(a + (b - a) * tenths / 10 AS DECIMAL(20,3)) AS p90 FROM q)
SELECT i_status, p90, count(*) FILTER (i_balance >= p90) AS above, count(*) AS n FROM invoices JOIN p USING (i_status) GROUP BY ALL
""", ["invoices"])
def w1_selected_percentile(cat: Catalog, p: RunParams) -> DataFrame:
    """The 90th percentile of balances by status, on every invoice of the status."""
    p90 = exact_percentile(cat.invoices, ["i_status"], "i_balance", 0.9, "p90").withColumn("p90", C("p90").cast("decimal(20,3)"))
    return cat.invoices.join(p90, "i_status").groupBy("i_status", "p90").agg(
        F.count_if(C("i_balance") >= C("p90")).alias("above"), F.count(F.lit(1)).alias("n"))


@plan("a19_selected_days", """
SELECT bucket, CAST(quantile_cont(days, 0.5) AS DECIMAL(10,1)) AS median_days FROM (
  SELECT d.branch_name AS bucket, date_diff('day', e.epi_SocDate, e.epi_DischargeDate) AS days FROM episodes e
  LEFT JOIN dim_branch d ON d.epi_slid = e.epi_slid AND rtrim(d.epi_branchcode) = rtrim(e.epi_branchcode)
  WHERE e.epi_DischargeDate IS NOT NULL) GROUP BY bucket
""", ["episodes", "dim_branch"])
def a19_selected_days(cat: Catalog, p: RunParams) -> DataFrame:
    """Days of stay by branch, stays without a branch in a group of their own."""
    stays = with_bucket(cat.episodes.filter(C("epi_DischargeDate").isNotNull()), cat.dim_branch).withColumn(
        "days", days_between("epi_SocDate", "epi_DischargeDate"))
    return exact_median(stays, ["bucket"], "days").select("bucket", C("median").cast("decimal(10,1)").alias("median_days"))


# ---------------------------------------------------------------- A3, A4: distinct counts of recurring runs
def _runs_of(cat: Catalog, p: RunParams, runs: int) -> DistinctDays:
    """A store after some daily runs, the last one for ``p``."""
    store = DistinctDays(cat.spark, _folder(cat, "distinct-days"), ("sl_desc", "branch_name"))
    for back in range(runs - 1, -1, -1):
        kpis.stored_daily_census(cat, RunParams.build(as_of=p.as_of - dt.timedelta(days=back)), store)
    return store


@plan("a3_stored_daily_census", "k05_daily_census")
def a3_stored_daily_census(cat: Catalog, p: RunParams) -> DataFrame:
    """K05 as the third run of a store: 14 of its days were stored by the runs before."""
    return _runs_of(cat, p, 3).by_day(p.start, p.end, "DailyCensus").withColumnRenamed("day", "CensusDate")


@plan("a4_stored_distinct_window", """
WITH days AS (SELECT CAST(unnest(generate_series({S}, {E}, INTERVAL 1 DAY)) AS DATE) AS day)
SELECT sl_desc, branch_name, count(DISTINCT epi_paid) AS patients
FROM episodes, days, service_lines, branches
WHERE rtrim(epi_status) = 'CURRENT' AND epi_SocDate <= day AND (epi_DischargeDate IS NULL OR epi_DischargeDate > day)
  AND sl_id = epi_slid AND rtrim(branch_code) = rtrim(epi_branchcode) GROUP BY ALL
""", ["episodes", "service_lines", "branches"])
def a4_stored_distinct_window(cat: Catalog, p: RunParams) -> DataFrame:
    """Different patients over the whole window, from the union of its days."""
    return _runs_of(cat, p, 1).over(p.start, p.end, "patients")


# ---------------------------------------------------------------- P4, P6, J4, A4: mixed case
def _either_case(c: str, key: str) -> Column:
    """A third of the rows in lower case, a third with capitals, with one blank more or less at the end."""
    return (F.when(C(key) % 3 == 0, F.lower(c)).when(C(key) % 3 == 1, F.concat(F.initcap(c), F.lit(" "))).otherwise(C(c)))


def mixed_case(cat: Catalog, codes: bool = True) -> Catalog:
    """The catalog with statuses (and codes) of facts spelt in any case, compared without it."""
    names = ["epi_status", "epi_AdmitType", *(["epi_branchcode", "epi_DcCode", "epi_NonAdmitCode"] if codes else [])]
    episodes = cat.episodes.withColumns({n: _either_case(n, "epi_id") for n in names})
    invoices = cat.invoices.withColumn("i_status", _either_case("i_status", "i_id"))
    visits = cat.visits_all.withColumn("cev_setsocdateflag", _either_case("cev_setsocdateflag", "cev_id"))
    return collated(replace(cat, episodes=episodes, invoices=invoices, visits=visits, visits_all=visits))


@plan("p4_mixed_case_statuses", "k01_admissions_by_branch")
def p4_mixed_case_statuses(cat: Catalog, p: RunParams) -> DataFrame:
    return kpis.k01_admissions_by_branch(mixed_case(cat), p)


@plan("p6_mixed_case_lists", "k04_billing_holds_sla")
def p6_mixed_case_lists(cat: Catalog, p: RunParams) -> DataFrame:
    return kpis.k04_billing_holds_sla(mixed_case(cat, codes=False), p)


@plan("j4_mixed_case_keys", "k05_daily_census")
def j4_mixed_case_keys(cat: Catalog, p: RunParams) -> DataFrame:
    return kpis.k05_daily_census(mixed_case(cat), p)


@plan("a4_mixed_case_distinct", "k07_discharges_by_class")
def a4_mixed_case_distinct(cat: Catalog, p: RunParams) -> DataFrame:
    """Distinct discharge codes and their classes, whatever their case."""
    return kpis.k07_discharges_by_class(mixed_case(cat), p)


# ---------------------------------------------------------------- R2, R5: batches and runs
@plan("r2_batch_literals", """
SELECT rtrim(epi_status) || ' ;  -- kept  "as" it is' AS label, count(*) AS n FROM episodes GROUP BY 1
""", ["episodes"])
def r2_batch_literals(cat: Catalog, p: RunParams) -> DataFrame:
    """A batch whose query holds blanks, a semicolon and a comment sign in a literal."""
    cat.register_views()
    return run_query(cat.spark, "USE default -- the database\nGO\nDECLARE @d date = (SELECT 1); /* ; GO */ SELECT "
                                "rtrim(epi_status) || ' ;  -- kept  \"as\" it is' AS label, count(*) AS n "
                                "FROM episodes GROUP BY 1;\nGO", p)


@plan("r5_failed_run_keeps_the_last", "k06_discharges_total")
def r5_failed_run_keeps_the_last(cat: Catalog, p: RunParams) -> DataFrame:
    """The reports that readers see after a second run failed in one of its reports."""
    out, stamp = _folder(cat, "runs"), "KPIReport"
    write_reports({"Discharges": kpis.k06_discharges_total(cat, p), "Days": kpis.k18_patient_days(cat, p)}, out, stamp)
    broken = cat.episodes.select(F.assert_true(C("epi_id") < 0).alias("never"))
    try:
        write_reports({"Discharges": kpis.k08_live_discharge_summary(cat, p), "Days": broken}, out, stamp)
    except Exception as error:                                  # any failure of a job
        if "epi_id" not in str(error):
            raise
    else:
        raise AssertionError("a report that fails was published")
    return cat.spark.read.parquet(published(cat.spark, out, stamp)["Discharges"].path)
