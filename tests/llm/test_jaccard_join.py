import random
from itertools import combinations

import numpy as np
import pytest

from careledger.llm import components, jaccard_join


def shingle_set(text, width=5):
    w = (text or "").encode().lower().split()
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def brute(rows, least=75):
    sets = [shingle_set(t) for _, t in rows]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if rows[i][0] is not None and rows[j][0] is not None and both and 100 * both >= least * len(sets[i] | sets[j]):
            a, b = find(rows[i][0]), find(rows[j][0])
            parent[max(a, b)] = min(a, b)
    return sorted([(d, len(s), find(d) if d is not None else None) for (d, _), s in zip(rows, sets)], key=str)


def check(make_docs, rows):
    got = jaccard_join.jaccard_components(make_docs(rows, 5)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == brute(rows)


def test_edge_rows(make_docs, edge_rows):
    check(make_docs, edge_rows)


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.mark.parametrize("block,few,short", [(256, 500_000, 256), (3, 0, 256), (256, 500_000, 1)])
def test_families_shared_passages_and_thresholds(make_docs, words, monkeypatch, block, few, short):
    """Families around the threshold, a passage that most documents share, copies, and texts of few words."""
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 5)
    monkeypatch.setattr(jaccard_join, "FEW_IDS", few)
    rng = random.Random(3)
    passage, rows = words("p", 30), []
    for f in range(6):
        base = words(("f", f), rng.randint(20, 160))
        for _ in range(rng.randint(2, 12)):
            text = edited(rng, base, rng.randint(0, 6))
            rows.append(text + " " + passage if rng.random() < 0.6 else text)
    rows += [passage + " " + words(("s", i), 12) for i in range(25)] + [passage] * 3 + ["one two", "ONE  two", "one two three"]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    check(make_docs, list(zip(ids, rows)))


def test_repeated_ids_share_a_component(make_docs, words):
    a, b = words(1, 40), words(2, 40)
    rows = [(1, a), (5, a + " x"), (5, b), (9, b + " y"), (7, words(3, 40))]
    got = {(r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(make_docs(rows)).collect()}
    assert got == {(1, 1), (5, 1), (9, 1), (7, 7)}


def test_keep_one_of_near(make_docs, words):
    docs = make_docs([(3, words(1, 50)), (2, words(1, 50) + " x"), (8, None), (9, ""), (None, words(1, 50))])
    kept = jaccard_join.keep_one_of_near(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [2, 8, 9, None]


def test_empty_table(make_docs):
    assert jaccard_join.jaccard_components(make_docs([])).count() == 0


def test_divide_skip_finds_what_a_scan_finds():
    rng = np.random.default_rng(5)
    for _ in range(40):
        query = np.unique(rng.integers(0, 120, 60).astype(np.uint64))
        others = [np.unique(np.concatenate([rng.choice(query, rng.integers(1, len(query) + 1), replace=False),
                                            rng.integers(0, 400, rng.integers(0, 30)).astype(np.uint64)])) for _ in range(12)]
        want = [k for k, o in enumerate(others)
                if len(np.intersect1d(query, o)) >= jaccard_join.required(len(query), len(o), 75)]
        assert sorted(jaccard_join.divide_skip(query, others, 75)) == want


def test_required_overlap_is_the_threshold():
    for n, m in [(1, 1), (7, 9), (100, 133), (100, 134), (550, 500)]:
        t = jaccard_join.required(n, m, 75)
        assert 100 * t >= 75 * (n + m - t) and 100 * (t - 1) < 75 * (n + m - t + 1)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 540)] + [(700, 700)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 500 for i in range(500, 540)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
