"""Plan checks: dimension joins broadcast, window filters reach the parquet
scan, no Python evaluation and no nested-loop / cartesian joins in any report."""

import pytest
from pyspark.sql import functions as F

from careledger.functions.predicates import in_window_by_date, in_window_half_open
from careledger.params import test_params as fixture_params
from careledger.plans.kpis import KPI_REPORTS

P = fixture_params()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(KPI_REPORTS))
def test_report_plan_shape(fixture_catalog, name):
    df = KPI_REPORTS[name](fixture_catalog, P)
    plan = _plan(df)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_dimension_join_is_broadcast(fixture_catalog):
    plan = _plan(KPI_REPORTS["k18_patient_days"](fixture_catalog, P))
    assert "BroadcastHashJoin" in plan


def test_window_filters_are_pushed_to_parquet(spark, fixture_catalog, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "episodes")
    fixture_catalog.episodes.write.parquet(path)
    e = spark.read.parquet(path)
    p7 = e.filter(in_window_by_date(F.col("epi_SocDate"), P.start, P.end))
    p9 = e.filter(in_window_half_open(F.col("epi_DischargeDate"), P.start, P.end))
    for df, col in ((p7, "epi_SocDate"), (p9, "epi_DischargeDate")):
        plan = _plan(df)
        assert f"GreaterThanOrEqual({col}" in plan and f"LessThan({col}" in plan


def test_census_is_an_expansion_not_a_range_join(fixture_catalog):
    plan = _plan(KPI_REPORTS["k05_daily_census"](fixture_catalog, P))
    assert "Generate" in plan and "NestedLoop" not in plan


_WRITERS = {"s5_script_folder_scan", "s6_definition_file_scan", "r5_write_reports", "r6_run_reports"}


def _registered():
    from careledger.plans import registry
    return registry.queries()


@pytest.mark.parametrize("name", sorted(n for n in _registered() if n not in _WRITERS and not n.startswith("k")))
def test_operator_plan_shape(spark, name):
    from tests.conftest import SF_SMALL
    plan = _plan(_registered()[name](spark, SF_SMALL))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.fixture(scope="module")
def stored_catalog(spark, fixture_catalog, tmp_path_factory):
    """The fixture tables as parquet, so that plans show what reaches the scans."""
    from careledger.sources.catalog import Catalog
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    root = str(tmp_path_factory.mktemp("stored"))
    for name in Catalog.__dataclass_fields__:
        if name not in ("spark", "dim_branch", "dim_branch_17"):
            getattr(fixture_catalog, name).write.parquet(f"{root}/{name}")
    return Catalog.from_parquet(spark, root, fixture_catalog.dim_branch, fixture_catalog.dim_branch_17)


@pytest.mark.parametrize("name", ["k02_admissions_by_care_type", "k15_lupa_by_threshold", "k16_bp1_summary",
                                  "k17_bp1_detail", "k19_qa_compliance"])
def test_history_is_reduced_before_it_is_aggregated(stored_catalog, name):
    """The semi-join with the window's episodes stands below the aggregate over the history table."""
    plan = KPI_REPORTS[name](stored_catalog, P)._jdf.queryExecution().optimizedPlan().toString()
    key = {"k02_admissions_by_care_type": "cect_epiid", "k15_lupa_by_threshold": "cev_epiid", "k16_bp1_summary": "cev_epiid",
           "k17_bp1_detail": "cev_epiid", "k19_qa_compliance": "ceat_epiid"}[name]
    lines = plan.splitlines()
    semi = [i for i, line in enumerate(lines) if "LeftSemi" in line and key in line]
    assert semi, plan
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    above = [line for line in lines[:semi[0]] if line.lstrip(" :+-|").startswith("Aggregate") and depth(line) < depth(lines[semi[0]])]
    assert above, plan


@pytest.mark.parametrize("name,key", [("k04_billing_holds_sla", "epi_id"), ("k04_billing_holds_sla", "i_id"),
                                      ("k26_revenue_by_branch", "epi_id"), ("k27_revenue_per_patient_day", "epi_id")])
def test_window_lines_reduce_the_other_side(stored_catalog, name, key):
    plan = KPI_REPORTS[name](stored_catalog, P)._jdf.queryExecution().optimizedPlan().toString()
    assert any("LeftSemi" in line and f"{key}#" in line for line in plan.splitlines()), plan


def test_visit_bounds_and_invoice_age_reach_the_scan(stored_catalog):
    plan = _plan(KPI_REPORTS["k15_lupa_by_threshold"](stored_catalog, P))
    assert "LessThan(cev_visitdate" in plan
    plan = _plan(KPI_REPORTS["k29_ar_over_90"](stored_catalog, P))
    assert "LessThan(i_postdate" in plan


def test_status_filters_reach_the_scan(stored_catalog):
    plan = _plan(KPI_REPORTS["k01_admissions_by_branch"](stored_catalog, P))
    assert "StringStartsWith(epi_status,CURRENT)" in plan


def test_census_joins_before_it_expands(stored_catalog):
    plan = KPI_REPORTS["k05_daily_census"](stored_catalog, P)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    expand = next(i for i, line in enumerate(lines) if "Generate" in line)
    assert sum("Join Inner" in line for line in lines[expand:]) == 2 and not any("Join Inner" in line for line in lines[:expand])


def test_wildcard_join_above_the_bound_hashes_on_line_and_code(spark, fixture_catalog, monkeypatch):
    from careledger.operators import branching
    monkeypatch.setattr(branching, "BRANCH_DIM_MAX_ROWS", 1)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = branching.with_bucket(fixture_catalog.episodes, fixture_catalog.dim_branch.limit(1000), wildcard=True)
        plan = _plan(df)
        line = next(x for x in plan.splitlines() if "SortMergeJoin" in x and "_dim_code" in x)
        assert "_dim_slid" in line and "NestedLoop" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_size_check_is_remembered_per_bound(spark):
    from careledger.operators.branching import within_rows
    df = spark.range(10)
    assert not within_rows(df, 1) and within_rows(df, 100_000) and not within_rows(df, 1)
