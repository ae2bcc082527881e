import zlib

import pytest

from careledger.llm import sharding


def check(rows, got, shards, overhead=16):
    size = lambda t: len((t or "").encode()) + overhead
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in got], key=str) == sorted(
        [(d, size(t), zlib.crc32((t or "").encode())) for d, t in rows], key=str)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    for k in range(shards):
        assert abs(sum(r.size for r in by.get(k, [])) - total / shards) <= largest


def test_edge_rows(make_docs, edge_rows):
    check(edge_rows, sharding.shard_documents(make_docs(edge_rows), 5).collect(), 5)


@pytest.mark.parametrize("range_rows", [7, 200_000])
def test_hot_text_is_split_and_sample_does_not_matter(make_docs, words, monkeypatch, range_rows):
    rows = [(i, "hot text" if i % 3 == 0 else words(i, 5 + i % 40)) for i in range(600)]
    monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
    got = sharding.shard_documents(make_docs(rows, 5), 8).collect()
    check(rows, got, 8)
    whole = sorted(got, key=lambda r: (r.shard, r.slot))
    monkeypatch.setattr(sharding, "DRAWS", 1)
    again = sharding.shard_documents(make_docs(rows, 3), 8).collect()
    assert [r.doc_id for r in whole] == [r.doc_id for r in sorted(again, key=lambda r: (r.shard, r.slot))]
    # Equal texts stand next to each other in the global order.
    spots = [k for k, r in enumerate(whole) if r.size == len("hot text") + 16]
    assert spots[-1] - spots[0] == len(spots) - 1


def test_ranges_are_found_by_binary_search(spark):
    cuts = [(-5, None, 0), (-5, 3, 1), (0, None, 7), (0, 2, 0), (0, 2, 9), (8, 8, 8)]
    rows = [(k, i, r) for k in (-6, -5, 0, 8, 9) for i in (None, 1, 2, 3, 8) for r in (0, 1, 7, 8, 9)]
    df = spark.createDataFrame(rows, "k long, id long, row long")
    for many in range(len(cuts) + 1):
        got = {(x.k, x.id, x.row): x.r for x in df.select("*", sharding._range_of(cuts[:many]).alias("r")).collect()}
        want = {x: sum(sharding._ordered(c) <= sharding._ordered(x) for c in cuts[:many]) for x in rows}
        assert got == want


def test_overfull_ranges_are_cut_until_none_is_left(spark, make_docs, words, monkeypatch):
    """One text without ids on most rows: neither text nor id can cut it, the rows' numbers do."""
    monkeypatch.setattr(sharding, "RANGE_ROWS", 20)
    rows = [(None, "the same text")] * 900 + [(7, "the same text")] * 300 + [(i, words(i, 12)) for i in range(100)]
    docs = make_docs(rows, 4)
    check(rows, sharding.shard_documents(docs, 6).collect(), 6)
    from pyspark.sql import functions as F
    keys = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("k"), F.octet_length("text").cast("long").alias("size"),
                       F.monotonically_increasing_id().alias("row"))
    total = keys.agg(F.sum("size")).first()[0]
    cuts = sharding.range_cuts(keys, 6, len(rows), total)
    sizes = keys.groupBy(sharding._range_of(cuts).alias("r")).count().collect()
    ranges = max(12, -(-len(rows) // 20))
    assert max(r["count"] for r in sizes) <= 2 * max(20, len(rows) / ranges)


def test_many_ranges_cost_like_few(spark, make_docs, words, monkeypatch):
    import time
    docs = make_docs([(i, words(i, 8)) for i in range(1500)], 4)
    took = {}
    for range_rows in (50, 3, 50, 3):
        monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
        start = time.time()
        sharding.shard_documents(docs, 8).collect()
        took[range_rows] = time.time() - start
    assert took[3] < 3 * took[50] + 2


def test_empty_table(make_docs):
    assert sharding.shard_documents(make_docs([]), 4).count() == 0


def test_write_shards(make_docs, spark, words, tmp_path):
    rows = [(i, words(i, 10)) for i in range(50)]
    sharding.write_shards(make_docs(rows), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(50))
    assert {r.shard for r in back.collect()} == {0, 1, 2, 3}
