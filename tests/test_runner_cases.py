"""The original runner's five tests, re-stated against the Spark jobs
(T2 audit, T4 names, T5 stamps, S5 folder scan, T3 extraction)."""

import datetime as dt
import re

from pyspark.sql import functions as F

from careledger.operators import scripts as T
from careledger.sources.scripts import definitions_from_folder, script_folder
from tests.conftest import d

FIXTURE_SQL = __import__("os").path.join(__import__("os").path.dirname(__file__), "fixtures", "sql")


def _audit(spark, text):
    df = spark.createDataFrame([("x", text)], "script_id string, text string")
    r = T.audit_scripts(df).first()
    return r["valid"], r["error"]


def test_validates_simple_select(spark):
    assert _audit(spark, "SELECT * FROM dbo.SalesSummary") == (True, None)
    valid, err = _audit(spark, "DELETE FROM dbo.SalesSummary")
    assert not valid and re.search("Only SELECT", err, re.I)


def test_rejects_multiple_statements_and_dynamic_sql(spark):
    valid, err = _audit(spark, "SELECT * FROM A; SELECT * FROM B")
    assert not valid and re.search("single statement", err, re.I)
    valid, err = _audit(spark, "EXEC sp_executesql N'SELECT 1'")
    assert not valid and re.search("Dynamic SQL", err, re.I)


def test_sanitizes_names_and_builds_file_names(spark):
    df = spark.createDataFrame([("Sales/Report:Test[1]?",)], "n string")
    assert df.select(T.sanitize_name(F.col("n"))).first()[0] == "Sales_Report_Test_1_"
    stamp = spark.range(1).select(T.report_stamp("KPIReport", F.current_date(), ".xlsx")).first()[0]
    assert re.fullmatch(r"KPIReport_\d{8}\.xlsx", stamp)
    fixed = spark.range(1).select(T.report_stamp("KPIReport", F.lit(d("1998-06-15")))).first()[0]
    assert fixed == "KPIReport_19980615"


def test_builds_definitions_from_a_folder(spark, tmp_path):
    defs = definitions_from_folder(spark, FIXTURE_SQL).collect()
    names = [r["name"] for r in defs]
    assert names == sorted(names) and "window_admissions" in names and "hold lines" in names
    assert "cleanup" not in names                        # only a DELETE: no query extracted
    scanned = [r["name"] for r in script_folder(spark, FIXTURE_SQL).collect()]
    assert "cleanup" in scanned and "notes" not in scanned  # *.SQL in any case; .txt ignored
    assert script_folder(spark, str(tmp_path / "missing")).count() == 0


def test_splits_multi_query_scripts_and_keeps_declarations(spark):
    script = ("\nUSE SampleDb\nDECLARE @AsOfDate date = CAST(GETDATE() AS date)\n"
              "SELECT @AsOfDate AS one;\nSELECT 2 AS two;\n")
    df = spark.createDataFrame([("s", script)], "script_id string, text string")
    qs = [r["query"] for r in T.extract_queries(df).orderBy("query_no").collect()]
    assert len(qs) >= 1
    joined = "\n".join(qs)
    assert re.search("SELECT", joined, re.I)
    assert re.search(r"DECLARE @AsOfDate date = CAST\(GETDATE\(\) AS date\)", joined, re.I)
    assert len(qs) == 2 and qs[1].endswith("SELECT 2 AS two")


def test_split_statements_strips_comments_and_go(spark):
    text = "SELECT 1 /* a; b */ -- c; d\r\ngo\nSELECT   2\t;  ;"
    df = spark.createDataFrame([("s", text)], "script_id string, text string")
    rows = T.split_statements(df).orderBy("stmt_no").collect()
    assert [(r["stmt_no"], r["statement"]) for r in rows] == [(0, "SELECT 1"), (1, "SELECT 2")]


def test_word_boundaries_are_ascii(spark):
    # 'égo' holds GO after a non-ASCII letter: a JavaScript \b splits there.
    df = spark.createDataFrame([("s", "SELECT égo FROM t")], "script_id string, text string")
    rows = [r["statement"] for r in T.split_statements(df).collect()]
    assert rows == ["SELECT é", "FROM t"]
    # sp_who is not the bare token sp_, so it is not dynamic SQL
    df2 = spark.createDataFrame([("s", "SELECT sp_who FROM t")], "script_id string, text string")
    assert T.audit_scripts(df2).first()["valid"]


def test_javascript_whitespace_and_line_terminators(spark):
    # U+2028 ends a -- comment (a JavaScript line terminator); NBSP and
    # U+3000 are whitespace for \s and trim().
    text = "SELECT\u00a01 -- note\u2028FROM t ;\u3000SELECT 2\u00a0"
    df = spark.createDataFrame([("s", text)], "script_id string, text string")
    rows = [r["statement"] for r in T.split_statements(df).orderBy("stmt_no").collect()]
    assert rows == ["SELECT 1 FROM t", "SELECT 2"]
