"""Report runs (R2, R5, R6) and the definition-file scan."""

import json
import os

import pytest

from careledger.params import test_params as fixture_params
from careledger.plans import kpis
from careledger.reports import run_query, run_reports, write_reports
from careledger.sources.scripts import definitions_file

FIXTURE_SQL = os.path.join(os.path.dirname(__file__), "fixtures", "sql")
P = fixture_params()
Q1 = "SELECT epi_slid, COUNT(*) AS n FROM episodes WHERE CAST(epi_SocDate AS DATE) BETWEEN :start AND :end GROUP BY epi_slid"
Q2 = "SELECT epi_status, COUNT(*) AS n FROM episodes GROUP BY epi_status"


def test_definition_file_forms(spark, tmp_path):
    arr = tmp_path / "defs.json"
    arr.write_text(json.dumps([{"name": "One", "query": Q1, "sourceFile": "a.sql"},
                               {"name": "Two", "query": [Q1, Q2]}]))
    rows = {r["name"]: r["query"] for r in definitions_file(spark, str(arr)).collect()}
    assert rows == {"One": [Q1], "Two": [Q1, Q2]}
    obj = tmp_path / "obj.json"
    obj.write_text(json.dumps({"reports": [{"name": "Three", "query": Q2}]}))
    assert [r["name"] for r in definitions_file(spark, str(obj)).collect()] == ["Three"]
    bad = tmp_path / "bad.json"
    bad.write_text("{not json")
    assert definitions_file(spark, str(bad)).count() == 0
    assert definitions_file(spark, str(tmp_path / "missing.json")).count() == 0


def test_run_query_binds_named_parameters(spark, fixture_catalog):
    fixture_catalog.register_views()
    got = {r["epi_slid"]: r["n"] for r in run_query(spark, Q1, P).collect()}
    assert sum(got.values()) == fixture_catalog.episodes.filter(
        "CAST(epi_SocDate AS DATE) BETWEEN DATE'1998-06-01' AND DATE'1998-06-15'").count()


def test_run_reports_from_definitions_and_folder(spark, fixture_catalog, tmp_path):
    fixture_catalog.register_views()
    defs = tmp_path / "defs.json"
    defs.write_text(json.dumps([{"name": "Admissions/Window", "query": Q1},
                                {"name": "Stacked", "query": [Q1, Q2]}]))
    out = tmp_path / "out"
    paths = run_reports(spark, P, out_dir=str(out), definitions_path=str(defs))
    assert sorted(os.path.basename(p) for p in paths.values()) == ["Admissions_Window", "Stacked"]
    assert all("KPIReport_19980615" in p for p in paths.values())
    stacked = spark.read.parquet(paths["Stacked"])
    assert stacked.columns == ["result_set", "epi_slid", "n"]
    # an unreadable definitions file falls back to the script folder
    bad = tmp_path / "bad.json"
    bad.write_text("[")
    paths = run_reports(spark, P, out_dir=str(out), definitions_path=str(bad), folder=FIXTURE_SQL)
    assert sorted(paths) == ["hold lines", "window_admissions"]


def test_run_reports_errors(spark, fixture_catalog, tmp_path):
    fixture_catalog.register_views()
    with pytest.raises(ValueError, match="No report definitions"):
        run_reports(spark, P, out_dir=str(tmp_path), definitions_path=None, folder=str(tmp_path / "none"))
    d = tmp_path / "d.json"
    d.write_text(json.dumps([{"name": "Bad", "query": "DELETE FROM episodes"}]))
    with pytest.raises(ValueError, match="Only SELECT"):
        run_reports(spark, P, out_dir=str(tmp_path), definitions_path=str(d))
    d.write_text(json.dumps([{"name": "Empty", "query": ""}]))
    with pytest.raises(ValueError, match="has no query"):
        run_reports(spark, P, out_dir=str(tmp_path), definitions_path=str(d))


def test_write_reports_placeholder_and_names(spark, fixture_catalog, tmp_path):
    future = type(P).build(as_of=P.as_of.replace(year=2035))
    paths = write_reports({"Empty: detail?": kpis.k17_bp1_detail(fixture_catalog, future),
                           "Days": kpis.k18_patient_days(fixture_catalog, P)}, str(tmp_path), "KPIReport_19980615")
    assert os.path.basename(paths["Empty: detail?"]) == "Empty_ detail_"
    rows = spark.read.parquet(paths["Empty: detail?"]).collect()
    assert [tuple(r) for r in rows] == [("No rows returned",)]
    assert spark.read.parquet(paths["Days"]).count() == kpis.k18_patient_days(fixture_catalog, P).count()


def test_run_kpi_reports_catalogue(spark, fixture_catalog, tmp_path):
    from careledger.reports import KPI_CATALOGUE, run_kpi_reports
    assert sorted(i for ids in KPI_CATALOGUE.values() for i in ids) == sorted(kpis.KPI_REPORTS)
    paths = run_kpi_reports(fixture_catalog, P, out_dir=str(tmp_path))
    assert len(paths) == 16
    disch = spark.read.parquet(paths["Discharges"])
    assert disch.columns[0] == "result_set"
    assert sorted(r[0] for r in disch.select("result_set").distinct().collect()) == [0, 1, 2]
    days = spark.read.parquet(paths["Patient Days"])
    assert days.count() == kpis.k18_patient_days(fixture_catalog, P).count()


def test_catalog_from_parquet_folders(spark, fixture_catalog, tmp_path):
    from dataclasses import fields
    from careledger.sources.catalog import Catalog
    for f in fields(fixture_catalog):
        if f.name not in ("spark", "dim_branch", "dim_branch_17"):
            getattr(fixture_catalog, f.name).write.parquet(str(tmp_path / f.name))
    cat = Catalog.from_parquet(spark, str(tmp_path), fixture_catalog.dim_branch, fixture_catalog.dim_branch_17)
    key = lambda t: tuple((v is not None, str(v)) for v in t)
    for name in ("k18_patient_days", "k04_billing_holds_sla"):
        a = sorted(map(tuple, kpis.KPI_REPORTS[name](cat, P).collect()), key=key)
        b = sorted(map(tuple, kpis.KPI_REPORTS[name](fixture_catalog, P).collect()), key=key)
        assert a == b


def test_command_line_run(spark, tmp_path, capsys):
    from careledger.__main__ import main
    from tests.conftest import SF_SMALL
    assert main(["--fixture", SF_SMALL, "--as-of", "1998-06-15", "--out", str(tmp_path)]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == 16 and all("KPIReport_19980615" in ln for ln in lines)
    assert main(["--fixture", SF_SMALL, "--as-of", "1998-06-15", "--out", str(tmp_path / "f"),
                 "--folder", FIXTURE_SQL]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert sorted(ln.split("\t")[0] for ln in lines) == ["hold lines", "window_admissions"]
