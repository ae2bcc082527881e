"""Published runs (R5, R6), batches (R2) and the order of scripts."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger import runs
from careledger.operators.scripts import split_batch
from careledger.params import test_params as fixture_params
from careledger.plans import kpis
from careledger.reports import run_kpi_reports, run_query, run_reports, write_reports
from careledger.sources import files
from careledger.sources.scripts import definitions_from_folder, script_folder

P = fixture_params()
STAMP = "KPIReport_19980615"


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def broken(spark):
    return spark.range(100).select(F.assert_true(F.col("id") < 50, F.lit("a report that fails")).alias("a"))


def test_a_failed_run_leaves_the_previous_one(spark, fixture_catalog, broken, tmp_path):
    days, totals = kpis.k18_patient_days(fixture_catalog, P), kpis.k06_discharges_total(fixture_catalog, P)
    write_reports({"Days": days, "Totals": totals}, str(tmp_path), STAMP)
    before = runs.published(spark, str(tmp_path), STAMP)
    with pytest.raises(Exception, match="a report that fails"):
        write_reports({"Days": totals, "Totals": broken}, str(tmp_path), STAMP)
    assert runs.published(spark, str(tmp_path), STAMP) == before
    assert _rows(runs.read_report(spark, str(tmp_path), STAMP, "Days")) == _rows(days)
    assert _rows(runs.read_report(spark, str(tmp_path), STAMP, "Totals")) == _rows(totals)
    # What the failed run wrote is gone; the next one replaces the reports together.
    assert len([n for n in os.listdir(tmp_path / STAMP) if n.startswith("run-")]) == 1
    paths = write_reports({"Days": totals}, str(tmp_path), STAMP)
    now = runs.published(spark, str(tmp_path), STAMP)
    assert list(now) == ["Days"] and now["Days"].path == paths["Days"] and now["Days"].rows == totals.count()


def test_a_run_of_definitions_fails_as_a_whole(spark, fixture_catalog, tmp_path):
    fixture_catalog.register_views()
    defs = tmp_path / "defs.json"
    defs.write_text(json.dumps([{"name": "A", "query": "SELECT 1 AS a"}, {"name": "B", "query": ["SELECT 2 AS b", "SELECT 3 AS b"]}]))
    out = str(tmp_path / "out")
    run_reports(spark, P, out_dir=out, definitions_path=str(defs))
    before = runs.published(spark, out, STAMP)
    assert before["B"].rows == 2
    defs.write_text(json.dumps([{"name": "A", "query": "SELECT 9 AS a"}, {"name": "B", "query": ["SELECT 2 AS b", "SELECT raise_error('no') AS b"]}]))
    with pytest.raises(Exception, match="no"):
        run_reports(spark, P, out_dir=out, definitions_path=str(defs))
    assert runs.published(spark, out, STAMP) == before
    assert [r.a for r in runs.read_report(spark, out, STAMP, "A").collect()] == [1]


def test_command_line_keeps_some_runs(spark, tmp_path, capsys):
    from careledger.__main__ import main
    from tests.conftest import SF_SMALL
    folder = tmp_path / "sql"
    folder.mkdir()
    (folder / "one.sql").write_text("SELECT count(*) AS n FROM episodes WHERE epi_status = 'current'")
    args = ["--fixture", SF_SMALL, "--as-of", "1998-06-15", "--out", str(tmp_path / "out"), "--folder", str(folder)]
    assert main(args) == 0 and main([*args, "--any-case"]) == 0
    paths = [line.split("\t")[1] for line in capsys.readouterr().out.strip().splitlines()]
    # Without case the status is found.
    assert [spark.read.parquet(p).first()["n"] > 0 for p in paths] == [False, True]
    assert main([*args, "--any-case", "--keep", "1"]) == 0
    assert len([n for n in os.listdir(tmp_path / "out" / STAMP) if n.startswith("run-")]) == 1
    assert runs.read_report(spark, str(tmp_path / "out"), STAMP, "one").count() == 1


def test_lost_and_concurrent_publishers(spark, tmp_path):
    one = spark.range(3)
    write_reports({"A": one}, str(tmp_path), STAMP)
    first = runs.published(spark, str(tmp_path), STAMP)
    # A manifest whose writer was lost half-way is no run.
    assert files.create_once(spark, f"{tmp_path}/{STAMP}/_published/000000002.json", '{"run": "run-x", "rep')
    assert not files.create_once(spark, f"{tmp_path}/{STAMP}/_published/000000002.json", "{}")
    assert runs.published(spark, str(tmp_path), STAMP) == first
    run = runs.Run(spark, str(tmp_path), STAMP)
    other = runs.Run(spark, str(tmp_path), STAMP)
    for r, n in ((run, 1), (other, 2)):
        spark.range(n).write.parquet(r.path("A"))
        r.add("A", "A", n, False)
    run.publish("parquet")
    other.publish("parquet")
    assert runs.published(spark, str(tmp_path), STAMP)["A"].rows == 2
    gone = runs.retire(spark, str(tmp_path), STAMP, keep=1)
    assert len(gone) == 2 and run.id in gone and runs.read_report(spark, str(tmp_path), STAMP, "A").count() == 2
    with pytest.raises(ValueError):
        runs.retire(spark, str(tmp_path), STAMP, keep=0)
    write_reports({"J": spark.range(2), "None": spark.range(0)}, str(tmp_path), STAMP, fmt="json")
    assert sorted(r.id for r in runs.read_report(spark, str(tmp_path), STAMP, "J").collect()) == [0, 1]
    assert [tuple(r) for r in runs.read_report(spark, str(tmp_path), STAMP, "None").collect()] == [("No rows returned",)]
    assert runs.published(spark, str(tmp_path), "never") == {}


def test_rows_are_counted_while_writing(spark, fixture_catalog, tmp_path, monkeypatch):
    """A whole run starts no emptiness jobs; empty reports and empty first result sets are still told."""
    def never(self):
        raise AssertionError("a job that only asks for emptiness")
    monkeypatch.setattr(DataFrame, "isEmpty", never)
    future = type(P).build(as_of=dt.date(2035, 1, 15))
    run_kpi_reports(fixture_catalog, future, out_dir=str(tmp_path))
    found = runs.published(spark, str(tmp_path), "KPIReport_20350115")
    assert len(found) == 16
    assert found["Patient Days"].placeholder == (found["Patient Days"].rows == 0)
    for o in found.values():
        written = spark.read.parquet(o.path)
        assert written.columns == ["No data"] and written.count() == 1 if o.placeholder else written.count() == o.rows
    assert any(o.placeholder for o in found.values()) and any(not o.placeholder for o in found.values())
    empty, some = spark.range(0).select(F.col("id").alias("x")), spark.range(4).select(F.col("id").alias("y"))
    from careledger.reports import _publish
    paths = _publish({"S": [empty, some]}, str(tmp_path), STAMP)
    assert spark.read.parquet(paths["S"]).columns == ["result_set", "y"]


# ---------------------------------------------------------------- R2
@pytest.mark.parametrize("sql,want", [
    ("USE default; SELECT 'a  b' AS x", "a  b"),
    ("USE default; SELECT 'p;q' AS x", "p;q"),
    ("USE default; SELECT 'p -- q' AS x", "p -- q"),
    ("USE default\nSELECT 'it''s' AS x", "it's"),
    ("USE default\nGO\nSELECT 'go; select' AS x;\nGO\n", "go; select"),
    ("DECLARE @a int = (SELECT 1); SET x 'a;b';\nWITH t AS (SELECT '/* c */' AS x) SELECT x FROM t -- end", "/* c */"),
    ("-- DECLARE @StartDate date\nUSE `default` -- here; there\n (SELECT \"it's; \" AS x)", "it's; "),
    ("/* USE nowhere; /* inner */ */ USE default; SELECT 'a\\'; b' AS x", "a'; b"),
    ("SELECT 'no setup;  at all' AS x", "no setup;  at all"),
    ("SET a 1 DECLARE @b int SELECT `x;y` AS x FROM VALUES ('v') AS t(`x;y`)", "v"),
])
def test_a_query_reaches_spark_as_it_is_written(spark, sql, want):
    assert run_query(spark, sql, P).first()["x"] == want


def test_what_a_batch_is_made_of(spark):
    def parts(sql):
        r = spark.createDataFrame([(sql,)], "t string").select(split_batch(F.col("t")).alias("b")).first()["b"]
        return r["setup"], r["query"], r["more"]
    assert parts("USE a; SET b 'x;y' ;\n  SELECT  1  ; -- end\nGO") == (["USE a", "SET b 'x;y'"], "\n  SELECT  1  ", False)
    assert parts("SELECT 1; SELECT 2") == ([], "SELECT 1", True)
    assert parts("USE a SELECT 1 AS go\n, 2 AS b\n go -- end\nSELECT 3") == (["USE a"], "SELECT 1 AS go\n, 2 AS b\n ", True)
    assert parts("use a") == (["use a"], "", False)
    assert parts("") == ([], "", False)
    assert parts("SELECT 1; /* nothing */ ;; GO -- more") == ([], "SELECT 1", False)
    long = "SELECT '" + "a;b''" * 20_000 + "' AS x"
    assert parts("USE a; " + long) == (["USE a"], " " + long, False)
    for sql in ("USE default; SELECT 1; SELECT 2", "USE default", "USE default; -- nothing"):
        with pytest.raises(ValueError, match="one query"):
            run_query(spark, sql, P)


# ---------------------------------------------------------------- S5
def test_scripts_in_the_order_of_their_plain_names(spark, tmp_path):
    for k, name in enumerate(["a!b.sql", "a b.sql", "a+b.SQL", "a%20b.sql", "_z é.sql", "￮.sql", "\U0001F600.sql", "b.txt"]):
        (tmp_path / name).write_text(f"SELECT {k} AS a")
    # By UTF-16 units a pair of surrogates comes before U+FFEE.
    want = ["_z é", "a b", "a!b", "a%20b", "a+b", "\U0001F600", "￮"]
    found = script_folder(spark, str(tmp_path)).collect()
    assert [r["name"] for r in found] == want
    assert all(r["sourceFile"].startswith(f"{tmp_path}/{r['name']}.") for r in found)
    defs = definitions_from_folder(spark, str(tmp_path)).collect()
    assert [d["name"] for d in defs] == want and [d["sourceFile"] for d in defs] == [r["sourceFile"] for r in found]
    assert script_folder(spark, f"{tmp_path}/missing").collect() == []
    assert definitions_from_folder(spark, f"{tmp_path}/missing").collect() == []


def test_other_errors_of_a_folder_are_not_hidden(spark, tmp_path, monkeypatch):
    (tmp_path / "a.sql").write_text("SELECT 1 AS a")
    monkeypatch.setattr("careledger.sources.scripts.names_in", lambda *a: ["a.sql"])
    with pytest.raises(Exception):
        script_folder(spark, f"{tmp_path}/missing").collect()
