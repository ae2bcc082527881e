"""Extra columns, whatever their names, change nothing and come out as they went in; rows are judged one by one."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from careledger.llm import (decontamination, exact_dedup, jaccard_join, language_id, queries, secrets, sharding,
                            suffix_dedup, toxicity)

SMALL = "/root/testdata/sf0.001"
CLASHING = ["_key", "key", "_digest", "digest", "_chars", "chars", "_part", "toxic", "id", "item_id", "_item", "n", "row",
            "fp", "component_id", "kept", "KEPT_too", "declared", "host", "p", "similarity", "a.b", "salt", "content", "number"]


def clashed(df):
    return df.withColumns({c: F.concat(F.lit(f"{c}: "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHING})


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels", "benchmark")}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:4])
def test_stages_keep_clashing_columns(spark, tables, name, stage):
    docs = tables["documents"].limit(120)
    plain = stage(spark, docs, SMALL)
    got = stage(spark, clashed(docs), SMALL)
    assert got.columns == clashed(docs).columns
    assert rows_of(got.select(plain.columns)) == rows_of(plain)
    assert rows_of(got) == rows_of(clashed(plain))


def test_operators_with_clashing_columns(tables):
    docs, labels, benchmark = tables["documents"], tables["labels"], tables["benchmark"]
    extra = clashed(docs)
    more_labels = labels.withColumns({c: F.lit("mine") for c in ("id", "text", "label", "n", "_part")})
    more_items = benchmark.withColumns({c: F.lit("mine") for c in ("doc_id", "_key", "similarity", "id")})
    for run in (lambda d: jaccard_join.jaccard_components(d),
                lambda d: exact_dedup.exact_dedup(d),
                lambda d: language_id.identify(language_id.document_rows(d)),
                lambda d: suffix_dedup.remove_repeats(d, width=50),
                lambda d: toxicity.toxicity_report(d, more_labels if d is extra else labels),
                lambda d: decontamination.decontaminate(d, more_items if d is extra else benchmark),
                lambda d: sharding.shard_documents(d, shards=40, overhead=16),
                lambda d: secrets.secret_report(d)):
        assert rows_of(run(extra)) == rows_of(run(docs))


def test_other_queries_read_no_other_columns(spark, tmp_path, tables):
    """op1, op10, op11, op12 and op13 on tables with clashing columns."""
    (clashed(tables["documents"]).drop("a.b")).write.parquet(f"{tmp_path}/documents.parquet")
    for t, key in (("pages", "page_id"), ("conversations", "conv_id")):
        df = spark.read.parquet(f"{SMALL}/{t}.parquet")
        df.withColumns({c: F.lit("mine") for c in CLASHING if c not in df.columns and c != "a.b"}).write.parquet(f"{tmp_path}/{t}.parquet")
    for name in ("op1_warc", "op10_bpe", "op12_cross_tokenizer_alignment", "op13_conversation_trie"):
        assert rows_of(queries.QUERIES[name](spark, str(tmp_path))) == rows_of(queries.QUERIES[name](spark, SMALL)), name
    got, want = ({r.doc_id: r for r in queries.op11_lm_scoring(spark, d).collect()} for d in (str(tmp_path), SMALL))
    assert got.keys() == want.keys()
    assert all(r.score == pytest.approx(want[i].score) and r.n_known == want[i].n_known for i, r in got.items())


def test_near_copies_are_judged_by_row(make_docs, words):
    a, b = words("a", 60), words("b", 60)
    rows = [(1, a), (2, a), (2, ""), (2, b), (None, a), (3, b + " more"), (4, words("c", 60)), (4, words("d", 60)), (5, None)]
    kept = sorted((str(r.doc_id), r.text or "") for r in jaccard_join.keep_one_of_near(make_docs(rows)).collect())
    # (2, a) is a copy of 1, (3, ...) of (2, b); all else stays.
    want = [(i, t or "") for i, t in rows if (i, t) not in ((2, a), (3, b + " more"))]
    assert kept == sorted((str(i), t) for i, t in want)


def test_equal_rows_without_an_id_leave_one(make_docs, words):
    text = words("same", 30)
    docs = make_docs([(None, text)] * 500 + [(None, text + " "), (7, text)])
    out = exact_dedup.exact_dedup(docs).collect()
    assert len(out) == 502 and sum(r.kept for r in out) == 1 and {r.group_size for r in out} == {502}
    assert [r.n_chars for r in out if r.kept] == [len(text) + 1]
    assert exact_dedup.keep_one_of_equal(docs).count() == 1
