"""The registered queries over a small table against their SQL, where SQL can express them."""

import duckdb
import pytest

from careledger.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    found = con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    want = sorted([tuple(r[names.index(c)] for c in sorted(names)) for r in found.fetchall()], key=str)
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(names)
    assert sorted([tuple(r[c] for c in sorted(names)) for r in got.collect()], key=str) == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op13_conversation_trie"}))
def test_one_row_per_document_or_page(spark, name):
    table = "pages" if name in ("op1_warc", "llm_page_language_id") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    want = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect())
    assert sorted(r[0] for r in queries.QUERIES[name](spark, SMALL).select(key).collect()) == want
