"""Case-blind catalogs (P4, P6, J4, A4): the reports' groups, and filters that still reach the scan."""

from dataclasses import fields

import pytest
from pyspark.sql import functions as F

from careledger.params import test_params as fixture_params
from careledger.plans import kpis
from careledger.plans.recurring_plans import mixed_case
from careledger.reports import run_query, stack_results
from careledger.sources.catalog import Catalog
from careledger.sources.collation import collated, preselect

P = fixture_params()


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", [n for n in sorted(kpis.KPI_REPORTS) if n[:3] in (
    "k01", "k02", "k04", "k06", "k07", "k10", "k12", "k14", "k15", "k16", "k19", "k20", "k23", "k24", "k27", "k28", "k30")])
def test_reports_on_mixed_case(fixture_catalog, name):
    """Statuses and flags in any case give the rows of the upper-case data."""
    assert _rows(kpis.KPI_REPORTS[name](mixed_case(fixture_catalog, codes=False), P)) == _rows(kpis.KPI_REPORTS[name](fixture_catalog, P))


@pytest.mark.parametrize("name", ["k01_admissions_by_branch", "k05_daily_census", "k07_discharges_by_class", "k18_patient_days",
                                  "k22_referral_conversion_strict", "k26_revenue_by_branch"])
def test_reports_on_mixed_case_codes(fixture_catalog, name):
    assert _rows(kpis.KPI_REPORTS[name](mixed_case(fixture_catalog), P)) == _rows(kpis.KPI_REPORTS[name](fixture_catalog, P))
    # Without the collation the same data loses rows.
    plain = {f.name: getattr(mixed_case(fixture_catalog), f.name) for f in fields(fixture_catalog)}
    for n, df in plain.items():
        if n != "spark":
            plain[n] = df.select(*[F.collate(c, "UTF8_BINARY").alias(c) if t.startswith("string") else c for c, t in df.dtypes])
    assert _rows(kpis.KPI_REPORTS[name](Catalog(**plain), P)) != _rows(kpis.KPI_REPORTS[name](fixture_catalog, P))


def test_filters_reach_the_scan(spark, fixture_catalog, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    for f in fields(fixture_catalog):
        if f.name not in ("spark", "dim_branch", "dim_branch_17"):
            getattr(fixture_catalog, f.name).write.parquet(str(tmp_path / f.name))
    cat = collated(Catalog.from_parquet(spark, str(tmp_path), fixture_catalog.dim_branch, fixture_catalog.dim_branch_17))
    for name, tests in {"k01_admissions_by_branch": ["StringStartsWith(epi_status,CU)", "StringStartsWith(epi_status,cu)",
                                                     "StringStartsWith(epi_AdmitType,NE)", "GreaterThanOrEqual(epi_SocDate"],
                        "k07_discharges_by_class": ["StringStartsWith(epi_status,dI)", "LessThan(epi_DischargeDate"],
                        "k16_bp1_summary": ["StringStartsWith(cev_setsocdateflag,y)"]}.items():
        plan = kpis.KPI_REPORTS[name](cat, P)._jdf.queryExecution().executedPlan().toString()
        for test in tests:
            assert test in plan, (name, test)


def test_preselection_loses_nothing(spark):
    values = ["KEPT", "kept", "Kept ", "Kept", "KE", "ked", "other", "", None, "k"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    c = df.select(F.collate("s", "UTF8_LCASE_RTRIM").alias("s"), F.col("s").alias("s__plain"))
    equal = lambda d: [r[0] for r in d.filter(F.col("s") == "KEPT").collect()]
    assert equal(preselect(c, s="KEPT")) == equal(c) == ["KEPT", "kept", "Kept ", "Kept"]
    assert [r[0] for r in preselect(c, s=("KEPT", "O")).collect()] == ["KEPT", "kept", "Kept ", "Kept", "KE", "ked", "other"]
    assert preselect(df, s="KEPT") is df


def test_brought_along_sql_and_stacking(spark, make_catalog, fixture_catalog):
    """SQL of definitions compares without case too, once the collated catalog's views are registered."""
    mixed_case(fixture_catalog).register_views()
    try:
        got = run_query(spark, "SELECT epi_status, count(*) AS n FROM episodes WHERE epi_status = 'current' GROUP BY epi_status", P).collect()
        assert [r.n for r in got] == [fixture_catalog.episodes.filter("rtrim(epi_status) = 'CURRENT'").count()]
        cat = collated(fixture_catalog)
        assert stack_results([kpis.k06_discharges_total(cat, P), kpis.k07_discharges_by_class(cat, P)]).count() > 0
    finally:
        fixture_catalog.register_views()


def test_one_spelling_of_equal_codes(spark, fixture_catalog):
    """A group of codes that differ in case is one row, named by its least spelling."""
    from dataclasses import replace
    invoices = fixture_catalog.invoices.withColumn("i_branchcode", F.when(F.col("i_id") % 2 == 0, F.lower("i_branchcode")).otherwise(F.col("i_branchcode")))
    got = kpis.k28_ar_aging(collated(replace(fixture_catalog, invoices=invoices)), P).collect()
    want = kpis.k28_ar_aging(fixture_catalog, P).collect()
    by_code = lambda rows: {(r.branch_code or "").upper(): r.ar_total for r in rows}
    assert len(got) == len(want) and by_code(got) == by_code(want)
