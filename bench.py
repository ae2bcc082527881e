"""Benchmark: the 30 KPI reports at one scale factor.

Runs every K query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``; each query runs once to warm up, then is timed over
``$BENCH_REPEAT`` runs (best time kept).  ``BENCH_LAYOUT=bucketed`` first
writes the episode-keyed tables bucketed by episode id (untimed) and runs
the reports on that layout.  Execution is forced with the
``noop`` sink, so the timing covers the whole plan without collecting rows.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from careledger.params import test_params, test_params_90  # noqa: E402
from careledger.plans.kpis import KPI_REPORTS, WIDE_WINDOW  # noqa: E402
from careledger.session import get_session  # noqa: E402
from careledger.sources.driver_tables import bind_driver_tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus), app="careledger-bench")
    # One catalog per run, as a scheduled run of all reports binds it once.
    cat = bind_driver_tables(spark, sf_dir)
    layout = os.environ.get("BENCH_LAYOUT", "bound")
    if layout == "bucketed":
        # Nightly layout refresh (not timed): episode-keyed tables bucketed alike.
        import uuid

        from careledger.session import ensure_checkpoint_dir
        from careledger.sources.layout import materialize_bucketed
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-layout-{uuid.uuid4().hex}"
        cat = materialize_bucketed(cat, root, database="careledger_bench", buckets=max(8, cpus))
    names = list(KPI_REPORTS)
    only = [a for a in sys.argv[1:]]
    if only:
        names = [n for n in names if any(o in n for o in only)]
    times = {}
    for name in names:
        params = test_params_90() if name in WIDE_WINDOW else test_params()
        report = KPI_REPORTS[name]
        report(cat, params).write.format("noop").mode("overwrite").save()          # warm-up
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            report(cat, params).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "kpi_reports_total_warm_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "layout": layout}))
    spark.stop()


if __name__ == "__main__":
    main()
