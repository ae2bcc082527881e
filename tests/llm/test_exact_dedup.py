import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from careledger.llm import exact_dedup


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for doc, text in rows:
        groups[norm(text)].append((-len(text or ""), (doc is not None, doc), doc))
    out = []
    for doc, text in rows:
        best = min(groups[norm(text)], key=lambda x: x[:2])
        out.append((doc, best[2], len(groups[norm(text)]), hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=str), {k: min(v, key=lambda x: x[:2]) for k, v in groups.items()}


def check(df, rows):
    got = df.collect()
    want, best = brute(rows)
    assert sorted([(r.id, r.keep_id, r.group_size, r.digest) for r in got], key=str) == want
    assert sum(r.kept for r in got) == len(best)              # one row of each group, also of repeated rows
    assert all(r.id == r.keep_id for r in got if r.kept)


def test_edge_rows(make_docs, edge_rows):
    check(exact_dedup.exact_dedup(make_docs(edge_rows)), edge_rows)


def test_hot_group_and_clashing_columns(make_docs):
    rows = [(i, "same text " + " " * (i % 3)) for i in range(300)] + [(1000 + i, f"text {i}") for i in range(20)]
    docs = make_docs(rows, 7).withColumns({c: F.lit(1) for c in ("id", "digest", "salt", "content", "best", "size", "c", "_part")})
    check(exact_dedup.exact_dedup(docs), rows)
    kept = exact_dedup.keep_one_of_equal(docs)
    assert kept.columns == docs.columns
    assert kept.count() == 21


def test_contents_decide_when_digests_collide(make_docs, edge_rows, monkeypatch):
    plain = exact_dedup._contents
    monkeypatch.setattr(exact_dedup, "_contents", lambda *a: plain(*a).withColumn("digest", F.substring("digest", 1, 1)))
    got = exact_dedup.exact_dedup(make_docs(edge_rows)).collect()
    want, best = brute(edge_rows)
    assert sorted([(r.id, r.keep_id, r.group_size) for r in got], key=str) == sorted([w[:3] for w in want], key=str)
    assert sum(r.kept for r in got) == len(best)


def test_keeps_one_of_repeated_rows(make_docs):
    docs = make_docs([(4, "a b"), (4, "a b"), (4, "other"), (None, "x"), (None, "x"), (5, "ab")])
    kept = sorted([(r.doc_id, r.text) for r in exact_dedup.keep_one_of_equal(docs).collect()], key=str)
    assert kept == sorted([(4, "a b"), (4, "other"), (None, "x")], key=str)


def test_empty_table(make_docs):
    assert exact_dedup.exact_dedup(make_docs([])).count() == 0
    assert exact_dedup.keep_one_of_equal(make_docs([])).count() == 0
