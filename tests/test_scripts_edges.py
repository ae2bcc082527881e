"""Script handling on names and texts that the fixtures lack."""

import json
import time

import pytest
from pyspark.sql import functions as F

from careledger.operators import scripts as T
from careledger.params import test_params as fixture_params
from careledger.reports import (common_type, load_definitions, run_query, run_reports, sheet_names, stack_results,
                                write_reports)
from careledger.sources.scripts import definitions_file, definitions_from_folder, script_folder

P = fixture_params()


def extract(spark, text):
    df = spark.createDataFrame([("s", text)], "script_id string, text string")
    return [r["query"] for r in T.extract_queries(df).orderBy("query_no").collect()]


def test_query_after_characters_beyond_the_basic_plane(spark):
    assert extract(spark, "USE \U0001F600\U0001F600 SELECT 1 AS a") == ["USE \U0001F600\U0001F600\nSELECT 1 AS a"]


def test_many_statements_take_linear_time(spark):
    def seconds(n):
        df = spark.createDataFrame([("s", "; ".join(f"SELECT {i} AS a" for i in range(n)))], "script_id string, text string")
        t = time.time()
        assert T.extract_queries(df).count() == n
        return time.time() - t
    seconds(500)
    assert seconds(4000) < 20


def test_hidden_and_twin_names_and_order(spark, tmp_path):
    for name, text in {"_x.sql": "SELECT 1 AS a", ".y.sql": "SELECT 2 AS a", "m.sql": "SELECT 3 AS a", "m.SQL": "SELECT 4 AS a",
                       "n.sql": "SELECT 5 AS a", "n - Fixed.sql": "SELECT 6 AS a", "o.txt": "SELECT 7 AS a"}.items():
        (tmp_path / name).write_text(text)
    names = [r["name"] for r in script_folder(spark, str(tmp_path)).collect()]
    assert names == [".y", "_x", "m", "m", "n - Fixed", "n"]
    defs = definitions_from_folder(spark, str(tmp_path)).collect()
    assert [(d["name"], d["query"]) for d in defs if d["name"] != "m"] == [
        (".y", ["SELECT 2 AS a"]), ("_x", ["SELECT 1 AS a"]), ("n - Fixed", ["SELECT 6 AS a"]), ("n", ["SELECT 5 AS a"])]
    assert sorted(d["query"][0] for d in defs if d["name"] == "m") == ["SELECT 3 AS a", "SELECT 4 AS a"]


def test_definitions_after_a_newline(spark, tmp_path):
    path = tmp_path / "defs.json"
    path.write_text('\n [{"name": "A", "query": "\\n SELECT 1 AS a"}]')
    assert [(r["name"], r["query"]) for r in definitions_file(spark, str(path)).collect()] == [("A", ["\n SELECT 1 AS a"])]


def test_stacking_keeps_every_value(spark):
    parts = [spark.range(1).select(F.lit(1).alias("v")), spark.range(1).select(F.lit("B01").alias("v")),
             spark.range(1).select(F.lit(5_000_000_000).alias("v"))]
    assert [r["v"] for r in stack_results(parts).orderBy("result_set").collect()] == ["1", "B01", "5000000000"]
    numbers = stack_results([parts[0], parts[2], spark.sql("SELECT CAST(1.25 AS DECIMAL(5,2)) AS v")])
    assert numbers.schema["v"].dataType.simpleString() == "decimal(21,2)"
    from pyspark.sql import types as K
    assert common_type([K.IntegerType(), K.LongType()]) == K.LongType()
    assert common_type([K.DateType(), K.IntegerType()]) == K.StringType()
    assert common_type([K.NullType(), K.DateType()]) == K.DateType()


def test_clashing_names_raise_before_anything_is_written(spark, tmp_path):
    one = spark.range(1)
    out = tmp_path / "out"
    for names in (["a/b", "a:b"], ["x" * 31 + "1", "x" * 31 + "2"], ["Name", "name"]):
        with pytest.raises(ValueError, match="would both be written"):
            write_reports({n: one for n in names}, str(out), "s")
    defs = tmp_path / "defs.json"
    defs.write_text(json.dumps([{"name": "A", "query": "SELECT 1 AS a"}, {"name": "A", "query": "SELECT 2 AS a"}]))
    with pytest.raises(ValueError, match="would both be written"):
        run_reports(spark, P, out_dir=str(out), definitions_path=str(defs))
    assert not out.exists()


def test_names_are_cut_at_utf16_units(spark):
    assert sheet_names(spark, ["\U0001F600" * 20, "a" + "\U0001F600" * 20, "b" * 40, "short"]) == [
        "\U0001F600" * 15, "a" + "\U0001F600" * 15, "b" * 31, "short"]


def test_setup_lines_extra_parameters_and_result_sets_written_once(spark, tmp_path):
    assert run_query(spark, "USE default; SELECT 1 AS a", P).first()["a"] == 1
    assert run_query(spark, "SET x 1; DECLARE @a int; SELECT :site AS s, :end AS e", P, site="n").first()["s"] == "n"
    assert spark.catalog.currentDatabase() == "default"
    with pytest.raises(ValueError, match="one query"):
        run_query(spark, "USE default; SELECT 1 AS a; SELECT 2 AS a", P)
    defs = tmp_path / "defs.json"
    defs.write_text(json.dumps([{"name": "A", "query": ["USE default; SELECT :site AS v", "SELECT rand() AS v"]}]))
    paths = run_reports(spark, P, out_dir=str(tmp_path / "out"), definitions_path=str(defs), extra={"site": "n"})
    assert [r["v"] for r in spark.read.parquet(paths["A"]).orderBy("result_set").collect()][0] == "n"


def test_folder_beside_the_definitions_is_the_default(spark, tmp_path):
    (tmp_path / "SQL").mkdir()
    (tmp_path / "SQL" / "q.sql").write_text("SELECT 1 AS a")
    assert [d["name"] for d in load_definitions(spark, str(tmp_path / "missing.json"), None)] == ["q"]
