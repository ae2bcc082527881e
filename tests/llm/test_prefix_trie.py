import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from careledger.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
SMALL = "/root/testdata/sf0.001"


def brute(rows):
    """The report from a dictionary of all prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0, digest), role, text))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[q] for q in children[p])
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def rows_of(df):
    assert df.columns == prefix_trie.OUTPUT
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (*r[:2], r[2] or 0))


def made(seed, convs, turns=4, texts=3):
    """Conversations that share many beginnings."""
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(["", "hé", "a longer text", "😀"][:texts]))
            for c in rng.sample(range(3 * convs), convs) for t in range(rng.randint(1, turns))]


@pytest.fixture(params=[1, 7, 60, 20_000])
def shards(request, monkeypatch):
    """Shards from one turn each to one shard for all."""
    monkeypatch.setattr(prefix_trie, "TURNS_A_SHARD", request.param)


def check(spark, rows, parts=5):
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert rows_of(prefix_trie.prefix_trie(df)) == sorted(want, key=lambda r: (*r[:2], r[2] or 0))


def test_shared_beginnings(spark, shards):
    check(spark, made(1, 150))


def test_edge_rows(spark, shards):
    """Nulls in every column, repeated rows, ties, conversations without turns of their own, absent first conversations,
    deep and hot paths."""
    rows = made(2, 40) + [(200, None, None, None), (200, None, "user", None), (200, 3, None, ""), (201, 1, "user", "x"),
                          (201, 1, "user", "x"), (201, 1, "user", "y"), (None, 1, "user", "z"), (None, None, None, None),
                          (303, 0, "a", "only"), (404, 0, "a", "only")]
    rows += [(500 + k, t, "user", f"turn {t}") for k in range(12) for t in range(40 - (k % 3))]
    rows += [(1000 + k, 0, "system", "the same") for k in range(60)]
    check(spark, rows)


def test_many_ends_in_one_node(spark, monkeypatch):
    """One node in which nearly all end, over many shards and several chunks of ids each."""
    monkeypatch.setattr(prefix_trie, "TURNS_A_SHARD", 5000)
    check(spark, [(c, 0, "user", "same") for c in range(30_000)] + made(3, 50))


def test_skeleton_that_is_too_large_loses_splitters(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TURNS_A_SHARD", 1)
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", 400)
    paths = prefix_trie.rebuilt(spark.createDataFrame(made(4, 80), SCHEMA))
    assert sum(len(p) for p, _ in prefix_trie.skeleton_of(paths).splitters) <= 400
    check(spark, made(4, 80))


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TURNS_A_SHARD", 1)
    monkeypatch.setattr(prefix_trie, "SAMPLE_CHARS", 500)
    monkeypatch.setattr(prefix_trie, "DRAWS", 1000)
    paths = prefix_trie.rebuilt(spark.createDataFrame(made(6, 200), SCHEMA))
    assert len(prefix_trie.skeleton_of(paths).splitters) < 40
    check(spark, made(6, 200))


def test_empty_table_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TURNS_A_SHARD", 10)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = made(5, 60)
    clash = spark.createDataFrame(rows, SCHEMA).withColumns(
        {n: F.lit("mine") for n in ("path", "sizes", "shard", "h", "conv", "family", "t", "depth", "kind")})
    assert rows_of(prefix_trie.prefix_trie(clash)) == sorted(brute(rows), key=lambda r: (*r[:2], r[2] or 0))


def test_whole_table(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TURNS_A_SHARD", 50)
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    assert rows_of(prefix_trie.prefix_trie(table)) == sorted(brute(rows), key=lambda r: (*r[:2], r[2] or 0))


def test_common_turns():
    a, b, c = "a" * 32, "b" * 32, "c" * 32
    for x, y, n in [("", "", 0), (a, "", 0), (a, a, 1), (a + b, a + c, 1), (a + b, a + b + c, 2), (b, c, 0)]:
        assert prefix_trie.common_turns(x, y) == n
