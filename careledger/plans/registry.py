"""Name -> (Spark query, oracle SQL) registry used by ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from careledger.params import test_params, test_params_90
from careledger.plans.kpis import KPI_REPORTS, WIDE_WINDOW
from careledger.plans import recurring_plans
from careledger.plans.operator_plans import OPERATOR_ORACLES, OPERATOR_QUERIES
from careledger.plans.oracle_kpis import kpi_oracle_sql
from careledger.sources.driver_tables import bind_driver_tables


def _kpi_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    report = KPI_REPORTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        params = test_params_90() if name in WIDE_WINDOW else test_params()
        return report(bind_driver_tables(spark, sf_dir), params)

    run.__name__ = name
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _kpi_query(name) for name in KPI_REPORTS}
    out.update(OPERATOR_QUERIES)
    out.update(recurring_plans.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out = {name: kpi_oracle_sql(name) for name in KPI_REPORTS}
    out.update(OPERATOR_ORACLES())
    out.update(recurring_plans.oracles())
    return out
