"""Report runs (R1-R6): parameters, parameterised SQL, stacking result sets,
the empty-result placeholder, one output per report, and the catalog loop.

Everything a report computes stays a DataFrame; the driver only sees the
list of report names and a row count per result set, observed while it is
written.  Outputs go under a run-stamped folder below the cluster's shared
checkpoint/output directory, are written by executors and published together
(``runs.py``); independent reports are submitted as concurrent Spark jobs from a
small driver thread pool.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careledger.operators.scripts import audit_text, report_stamp, sanitize_name, split_batch
from careledger.params import RunParams
from careledger.runs import Run
from careledger.sources.scripts import definitions_file, definitions_from_folder, sibling_folder

NO_DATA_COLUMN = "No data"
NO_DATA_VALUE = "No rows returned"
RESULT_SET_COLUMN = "result_set"


def run_params(as_of=None, start=None, end=None, **kw) -> RunParams:
    """R1."""
    return RunParams.build(as_of=as_of, start=start, end=end, **kw)


def run_query(spark: SparkSession, sql: str, params: RunParams, **extra) -> DataFrame:
    """R2: one query with named markers ``:start :end :as_of :sla_cutoff :hce_factor`` and those of ``extra``.

    A batch may set things up before its query (T2 accepts ``USE``, ``SET`` and
    ``DECLARE`` lines): ``USE`` names the current database while the query is
    resolved; ``SET`` and ``DECLARE`` have no meaning here, since parameters are
    bound by name.  What follows those lines reaches Spark as it is written."""
    batch = spark.createDataFrame([(sql,)], "t string").select(split_batch(F.col("t")).alias("b")).first()["b"]
    if not batch["setup"]:
        return spark.sql(sql, args={**params.sql_args(), **extra})
    if batch["more"] or not batch["query"]:
        raise ValueError("A batch with setup lines needs one query.")
    before = spark.catalog.currentDatabase()
    try:
        for line in batch["setup"]:
            name = re.match(r"(?is)use\s+(?:[`\[\"]([^`\]\"]+)|([\w.$]+))", line)
            if name:
                spark.catalog.setCurrentDatabase(name[1] or name[2])
        return spark.sql(batch["query"], args={**params.sql_args(), **extra})
    finally:
        spark.catalog.setCurrentDatabase(before)


def common_type(types: list[T.DataType]) -> T.DataType:
    """A type that holds every value of all ``types``; text where no other does."""
    kinds = [t for t in types if not isinstance(t, T.NullType)]
    if not kinds:
        return types[0]
    if all(t == kinds[0] for t in kinds):
        return kinds[0]
    whole = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    if all(type(t) in whole for t in kinds):
        return max(kinds, key=lambda t: whole[type(t)])
    if all(type(t) in whole or isinstance(t, T.DecimalType) for t in kinds):
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in kinds)
        digits = max(t.precision - t.scale if isinstance(t, T.DecimalType) else whole[type(t)] for t in kinds)
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else T.StringType()
    if all(isinstance(t, (T.FloatType, T.DoubleType)) for t in kinds):
        return T.DoubleType()
    return T.StringType()


def stack_results(results: list[DataFrame], rows: list[int] | None = None) -> DataFrame:
    """Result sets of one report, in order, under the columns of the
    first non-empty one (``rows``: how many rows each has, where that is known).  Other columns are dropped, missing ones are NULL;
    a column takes a type that holds the values of all its result sets, so no
    value is lost; ``result_set`` keeps the order of the result sets."""
    if not results:
        raise ValueError("no result sets")
    header = next((df for i, df in enumerate(results) if (rows[i] if rows else not df.isEmpty())), results[0])
    types = {n: common_type([df.schema[n].dataType for df in results if n in df.columns]) for n in header.columns}
    aligned = []
    for i, df in enumerate(results):
        have = set(df.columns)
        cols = [(F.col(f"`{n}`") if n in have else F.lit(None)).cast(t).alias(n) for n, t in types.items()]
        aligned.append(df.select(F.lit(i).alias(RESULT_SET_COLUMN), *cols))
    out = aligned[0]
    for df in aligned[1:]:
        out = out.unionByName(df)
    return out


def _placeholder(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(NO_DATA_VALUE,)], f"`{NO_DATA_COLUMN}` string")


def placeholder_if_empty(df: DataFrame) -> DataFrame:
    """An empty result becomes one row ``No data = 'No rows returned'``."""
    return _placeholder(df.sparkSession) if df.isEmpty() else df


def output_root(spark: SparkSession) -> str:
    """Shared folder for report outputs: below the cluster's checkpoint dir."""
    from careledger.session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark).rstrip("/") + "/reports"


def sheet_names(spark: SparkSession, names: list[str]) -> list[str]:
    """T4 for the handful of report names of a run (a bounded list)."""
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    rows = df.select("i", sanitize_name(F.col("n")).alias("s")).orderBy("i").collect()
    return [r["s"] for r in rows]


def stamp_for(spark: SparkSession, run_date: dt.date, prefix: str = "KPIReport") -> str:
    """T5 for one run date."""
    return spark.range(1).select(report_stamp(prefix, F.lit(run_date).cast("date")).alias("s")).first()["s"]


def refuse_clashes(spark: SparkSession, names: list[str]) -> list[str]:
    """Output names of the reports; two reports that would share one (also but for case) are an error."""
    sheets = sheet_names(spark, names)
    seen: dict[str, str] = {}
    for name, sheet in zip(names, sheets, strict=True):
        if sheet.casefold() in seen:
            raise ValueError(f"Reports {seen[sheet.casefold()]!r} and {name!r} would both be written as {sheet!r}.")
        seen[sheet.casefold()] = name
    return sheets


def _write_all(frames: dict, paths: dict, fmt: str, threads: int = 8) -> dict:
    """Write each frame once, as concurrent Spark jobs; returns how many rows each has, counted while writing."""
    def write(name) -> int:
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        frames[name].observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(paths[name])
        return seen.get["rows"]

    if not frames:
        return {}
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(frames)))) as pool:
        return dict(zip(frames, pool.map(write, list(frames)), strict=True))


def write_reports(reports: dict[str, DataFrame], out_dir: str, stamp: str, fmt: str = "parquet",
                  threads: int = 4) -> dict[str, str]:
    """One output per report, published together as one run under ``out_dir/stamp`` (``runs.py``).

    Names that clash after cleaning and cutting raise before anything is written.
    Each report is computed once; its rows are counted while they are written, and
    an empty one is replaced by the R4 placeholder.  If any report fails, nothing is
    published and the run before stays the current one."""
    return _publish({n: [df] for n, df in reports.items()}, out_dir, stamp, fmt, threads)


def _publish(reports: dict[str, list[DataFrame]], out_dir: str, stamp: str, fmt: str = "parquet",
             threads: int = 8) -> dict[str, str]:
    """Reports by their result sets, written as one run.

    The only result set of a report is written as its output; several are written as
    parts first, so that none is computed twice, and stacked from those."""
    if not reports:
        return {}
    spark = next(iter(reports.values()))[0].sparkSession
    run = Run(spark, out_dir, stamp)
    outputs = dict(zip(reports, refuse_clashes(spark, list(reports)), strict=True))
    paths = {n: run.path(o) for n, o in outputs.items()}
    try:
        parts = {(n, i): df for n, dfs in reports.items() if len(dfs) > 1 for i, df in enumerate(dfs)}
        places = {key: run.part(k) for k, key in enumerate(parts)}
        single = {n: dfs[0] for n, dfs in reports.items() if len(dfs) == 1}
        rows = _write_all({**single, **parts}, {**paths, **places}, fmt, threads)
        stacked = {}
        for name, dfs in reports.items():
            if len(dfs) > 1:
                keys = [(name, i) for i in range(len(dfs))]
                stacked[name] = stack_results([spark.read.schema(parts[k].schema).format(fmt).load(places[k]) for k in keys],
                                              [rows[k] for k in keys])
        rows |= _write_all(stacked, paths, fmt, threads)
        empty = [n for n in reports if not rows[n]]
        _write_all({n: _placeholder(spark) for n in empty}, paths, fmt, threads)
        for name, output in outputs.items():
            run.add(name, output, rows[name], name in empty)
        run.publish(fmt)
    except BaseException:
        run.discard()
        raise
    return paths


# Report name -> its result sets, stacked in this order (one output each).
KPI_CATALOGUE = {
    "Admissions": ["k01_admissions_by_branch", "k02_admissions_by_care_type"],
    "Days to Admit": ["k03_days_to_admit"],
    "Billing Holds": ["k04_billing_holds_sla"],
    "Daily Census": ["k05_daily_census"],
    "Discharges": ["k06_discharges_total", "k07_discharges_by_class", "k08_live_discharge_summary"],
    "Census Equivalent": ["k09_hce_by_branch", "k10_hce_combined", "k11_hce_total"],
    "Length of Stay": ["k12_los_discharged", "k13_los_active"],
    "LUPA": ["k14_lupa_by_reimbursement", "k15_lupa_by_threshold"],
    "BP1 Visits": ["k16_bp1_summary", "k17_bp1_detail"],
    "Patient Days": ["k18_patient_days"],
    "QA Compliance": ["k19_qa_compliance"],
    "Recertifications": ["k20_recert_rate", "k21_recert_share_of_episodes"],
    "Referral Conversion (strict)": ["k22_referral_conversion_strict", "k23_nonadmit_reasons_dedup"],
    "Referral Conversion": ["k24_referral_conversion", "k25_nonadmit_reasons_raw"],
    "Revenue": ["k26_revenue_by_branch", "k27_revenue_per_patient_day"],
    "Receivables and Unbilled": ["k28_ar_aging", "k29_ar_over_90", "k30_unbilled"],
}


def run_kpi_reports(cat, params: RunParams, out_dir: str | None = None, prefix: str = "KPIReport",
                    catalogue: dict[str, list[str]] | None = None) -> dict[str, str]:
    """The scheduled run: every report of the catalogue for one run date,
    its result sets stacked (R3), one output per report (R5), published as one run.

    Every result set is computed exactly once, and its rows are counted while it is
    written; stacking unions the small written outputs instead of running the reports again."""
    from careledger.plans.kpis import KPI_REPORTS
    spark = cat.spark
    catalogue = catalogue or KPI_CATALOGUE
    stamp = stamp_for(spark, params.end, prefix)
    refuse_clashes(spark, list(catalogue))
    return _publish({name: [KPI_REPORTS[i](cat, params) for i in ids] for name, ids in catalogue.items()},
                    out_dir or output_root(spark), stamp)


def load_definitions(spark: SparkSession, definitions_path: str | None, folder: str | None) -> list[dict]:
    """R6 catalog: definitions when the file yields any, else the script folder
    (by default the folder ``SQL`` beside the definitions file)."""
    defs = []
    if definitions_path:
        defs = [r.asDict() for r in definitions_file(spark, definitions_path).collect()]
    folder = folder or (sibling_folder(definitions_path) if definitions_path else None)
    if not defs and folder:
        defs = [r.asDict() for r in definitions_from_folder(spark, folder).collect()]
    if not defs:
        raise ValueError("No report definitions were found.")
    return defs


def validate_queries(spark: SparkSession, name: str, queries: list[str] | None) -> None:
    """The gate of the runner: a report needs a non-empty query, and every
    query must pass the audit (T2)."""
    queries = [q for q in (queries or [])]
    if not queries or not any(q for q in queries if q):
        raise ValueError(f"Report {name or 'Unnamed'} has no query.")
    df = spark.createDataFrame([(i, q) for i, q in enumerate(queries)], "i int, q string")
    for r in df.select("i", audit_text(F.col("q")).alias("a")).orderBy("i").collect():
        if not r["a"]["valid"]:
            raise ValueError(r["a"]["error"] or "Query script contains unsupported or unsafe statements.")


def run_reports(spark: SparkSession, params: RunParams, out_dir: str | None = None,
                definitions_path: str | None = None, folder: str | None = None,
                prefix: str = "KPIReport", extra: dict | None = None) -> dict[str, str]:
    """Load the definitions, validate, run each report's queries with the
    run parameters (and the named ``extra`` ones), stack its result sets and
    write one output per report.  Reports that share a name are an error."""
    defs = load_definitions(spark, definitions_path, folder)
    refuse_clashes(spark, [d["name"] for d in defs])
    for d in defs:
        validate_queries(spark, d["name"], d["query"])
    results = {d["name"]: [run_query(spark, q, params, **(extra or {})) for q in d["query"]] for d in defs}
    return _publish(results, out_dir or output_root(spark), stamp_for(spark, params.end, prefix))
