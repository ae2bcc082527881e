"""Command line: one scheduled run of the reports for a run date.

    python -m careledger --fixture /root/testdata/sf0.01 --as-of 1998-06-15 --out /shared/reports
    python -m careledger --tables /warehouse/care --branch-dim /warehouse/care/dim_branch --out ...
    python -m careledger --fixture ... --definitions defs.json --folder scripts/ --out ...

Without ``--definitions`` / ``--folder`` it runs the built-in catalogue (all
30 result sets as 16 reports); with them, the SQL definitions or the script
folder (R6).  Prints one line per written report.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from careledger.params import RunParams
from careledger.reports import output_root, run_kpi_reports, run_reports, stamp_for
from careledger.runs import retire
from careledger.session import apply_cluster_conf, ensure_checkpoint_dir
from careledger.sources.collation import collated


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="careledger", description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--fixture", help="driver parquet folder bound by the fixture rules")
    src.add_argument("--tables", help="folder with one parquet folder per report table")
    ap.add_argument("--branch-dim", help="parquet folder of the branch dimension (with --tables)")
    ap.add_argument("--branch-dim-17", help="the variant dimension (default: --branch-dim)")
    ap.add_argument("--as-of"), ap.add_argument("--start"), ap.add_argument("--end")
    ap.add_argument("--definitions", help="JSON report definitions (R6)")
    ap.add_argument("--folder", help="folder of *.sql scripts (R6 fallback)")
    ap.add_argument("--out", help="output folder (default: <spark.checkpoint.dir>/reports)")
    ap.add_argument("--any-case", action="store_true", help="compare strings without case, as SQL Server usually does")
    ap.add_argument("--keep", type=int, help="runs of the same stamp that stay, the new one included (default: all)")
    ap.add_argument("--cluster-conf", action="store_true", help="apply the large-cluster SQL settings")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("careledger").getOrCreate()
    if args.cluster_conf:
        apply_cluster_conf(spark)
    ensure_checkpoint_dir(spark)
    params = RunParams.build(as_of=args.as_of, start=args.start, end=args.end)

    if args.fixture:
        from careledger.sources.driver_tables import bind_driver_tables
        cat = bind_driver_tables(spark, args.fixture)
    else:
        from careledger.sources.catalog import Catalog
        if not args.branch_dim:
            ap.error("--tables needs --branch-dim")
        dim = spark.read.parquet(args.branch_dim)
        dim17 = spark.read.parquet(args.branch_dim_17) if args.branch_dim_17 else None
        cat = Catalog.from_parquet(spark, args.tables, dim, dim17)

    if args.any_case:
        cat = collated(cat)
    out = args.out or output_root(spark)
    if args.definitions or args.folder:
        cat.register_views()
        paths = run_reports(spark, params, out_dir=out, definitions_path=args.definitions, folder=args.folder)
    else:
        paths = run_kpi_reports(cat, params, out_dir=out)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    if args.keep:
        retire(spark, out, stamp_for(spark, params.end), args.keep)
    return 0


if __name__ == "__main__":
    sys.exit(main())
