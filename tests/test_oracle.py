"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names, order-insensitive values), plus a smoke run of the entries
that have no oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from careledger.plans import registry
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_kpi_and_operator_is_registered():
    ids = {n.split("_", 1)[0] for n in QUERIES}
    expected = ({f"k{i:02d}" for i in range(1, 31)} | {f"s{i}" for i in range(1, 8)}
                | {f"p{i}" for i in range(1, 17)} | {f"j{i}" for i in range(1, 14)}
                | {f"a{i}" for i in range(1, 21)} | {"w1", "o1", "o2", "o3", "u1"}
                | {f"f{i}" for i in range(1, 19)} | {f"r{i}" for i in range(1, 7)} | {f"t{i}" for i in range(1, 6)})
    assert expected <= ids


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(ORACLES[name])
    orows, ocols = cur.fetchall(), [x[0] for x in cur.description]
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(scols, srows)[0] == digest(ocols, orows)[0]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["bucket", "bucket_sort", "window_start", "window_end", "revenue", "patient_days",
                          "revenue_per_patient_day"]
