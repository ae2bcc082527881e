import importlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from careledger.llm import bpe

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pipeline():
    return importlib.import_module("corpus_pipeline")


def test_stages_filter_and_keep_the_columns(spark, pipeline, make_docs, words, tmp_path):
    """Planted rows: each stage drops what is its own and nothing else; the rest comes out tokenized."""
    bench = words("item", 30)
    clean = [(i, words(("clean", i), 60)) for i in range(20)]
    rows = [*clean, (100, ""), (101, None), (102, "12 34 --"), (103, clean[0][1] + " \n"), (104, clean[1][1]),
            (105, clean[2][1] + " tail"), (106, words("own", 40) + " " + bench), (None, words("none", 50))]
    docs = make_docs(rows).withColumn("source", F.concat(F.lit("s"), F.col("doc_id") % 3))
    spark.createDataFrame([(0, bench)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = []
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "bpe":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
    every = {d for d, _ in rows}
    assert left[0] == every - {100, 101, 102}
    assert left[1] == left[0] - {0, 104} or left[1] == left[0] - {103, 104}
    assert left[2] == left[1] - {105}
    assert left[3] == left[4] == left[2] - {106}
    vocab = bpe.vocabulary(public_tokenizers.path(pipeline.VOCABULARY))
    texts = dict(rows)
    for r in docs.collect():
        import numpy as np
        assert vocab.decode(np.array(r.ids, np.int32)).decode() == texts[r.doc_id]


def test_order_of_stages(pipeline):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "decontamination", "bpe"]


def test_run_and_registry(spark):
    import __spark_entry__ as entry
    queries = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in queries if q.startswith("op")
                                                 and q[2:].split("_")[0].isdigit()}
    out = queries["pipeline"](spark, SMALL)
    assert out.columns == ["doc_id", "ids"] and 0 < out.count() <= 200


def test_empty_documents(spark, pipeline, make_docs, tmp_path):
    spark.createDataFrame([(0, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in pipeline.STAGES:
        assert stage(spark, make_docs([]), str(tmp_path)).count() == 0
