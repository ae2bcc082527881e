"""Script folders and report-definition files.

A definition is ``struct<name string, query array<string>, sourceFile string>``.
Both sources are read by Spark (``text`` with ``wholetext`` / ``json``), so a
folder of thousands of scripts is split and audited on executors; only the
short list of report definitions ever reaches the driver (R6).
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from careledger.operators.scripts import extract_queries, js_trim
from careledger.sources.files import names_in

DEFINITION_SCHEMA = "name string, query array<string>, sourceFile string"
_RAW_ENTRY = "struct<name: string, query: string, sourceFile: string>"


def _hidden_scripts(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """(file_name, text) of scripts whose names begin with ``_`` or ``.``.

    Spark's file sources pass such names over, so the tasks open these few
    files themselves, from the folder's own file system."""
    folder = folder if "://" in folder else os.path.abspath(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with own.open_input_stream(f"{root.rstrip('/')}/{name}") as stream:
                    text = stream.read().decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text])], names=["file_name", "text"])

    return (spark.createDataFrame([(n,) for n in names], "name string").repartition(len(names))
            .mapInArrow(read, "file_name string, text string"))


def _in_name_order(df: DataFrame) -> DataFrame:
    """Ordered by whole file names, by UTF-16 units as the runner sorts them."""
    return df.orderBy(F.encode("file_name", "UTF-16BE"))


def _script_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, text, sourceFile) of every ``*.sql`` file, unordered; ``sourceFile`` is the folder as it was given
    and the plain file name."""
    schema = "file_name string, text string, sourceFile string"
    names = [n for n in names_in(spark, folder) if n.lower().endswith(".sql")]
    if not names:
        return spark.createDataFrame([], schema)
    parts = []
    if any(n[:1] not in "_." for n in names):
        # _metadata.file_name is URI-encoded (a blank is %20); '+' is protected
        # from form decoding first.
        name = F.url_decode(F.regexp_replace(F.col("_metadata.file_name"), "\\+", "%2B"))
        parts.append(spark.read.text(folder, wholetext=True).select(name.alias("file_name"), F.col("value").alias("text"))
                     .filter(F.lower("file_name").endswith(".sql")))
    hidden = [n for n in names if n[:1] in "_."]
    if hidden:
        parts.append(_hidden_scripts(spark, folder, hidden))
    found = functools.reduce(DataFrame.unionByName, parts)
    return found.withColumn("sourceFile", F.concat(F.lit(folder.rstrip("/") + "/"), "file_name"))


def _report_name() -> Column:
    return F.regexp_replace("file_name", "(?i)\\.sql$", "").alias("name")


def script_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.sql`` file (any case, also names that begin with ``_`` or
    ``.``) of ``folder`` as (name, text, sourceFile), in the order of the whole
    file names; a missing folder gives an empty frame."""
    return _in_name_order(_script_files(spark, folder)).select(_report_name(), "text", "sourceFile")


def definitions_from_folder(spark: SparkSession, folder: str) -> DataFrame:
    """S5 + T3: one definition per script that yields at least one query, in file-name order.

    Scripts are told apart by their file (``m.sql`` and ``m.SQL`` are two)."""
    files = _script_files(spark, folder).withColumn("_file", F.struct("file_name", "sourceFile"))
    q = extract_queries(files, id_col="_file")
    agg = q.groupBy("script_id").agg(F.sort_array(F.collect_list(F.struct("query_no", "query"))).alias("_qs"))
    return _in_name_order(agg.select("script_id.*", "_qs")).select(
        _report_name(), F.transform("_qs", lambda x: x["query"]).alias("query"), "sourceFile")


def sibling_folder(path: str, name: str = "SQL") -> str:
    """The folder ``name`` beside a definitions file (the default script folder)."""
    return f"{path.rsplit('/', 1)[0] if '/' in path else '.'}/{name}"


def definitions_file(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of definitions, or an object with a ``reports`` array.

    ``query`` may be a string or an array of strings; a string becomes a
    one-element array, array order is kept.  An unreadable file gives an
    empty frame."""
    empty = spark.createDataFrame([], DEFINITION_SCHEMA)
    try:
        raw = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return empty
    as_array = F.from_json("value", f"array<{_RAW_ENTRY}>")
    as_object = F.from_json("value", f"struct<reports: array<{_RAW_ENTRY}>>")["reports"]
    # from_json would wrap a lone object into a one-element array: choose by the first character.
    is_array = js_trim(F.col("value")).startswith("[")
    entries = raw.select(F.explode(F.when(is_array, as_array).otherwise(as_object)).alias("d"))
    q = F.col("d.query")
    query = F.when(js_trim(q).startswith("["), F.from_json(q, "array<string>")).otherwise(F.array(q))
    return entries.select(F.col("d.name").alias("name"), query.alias("query"),
                          F.col("d.sourceFile").alias("sourceFile"))
