import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from careledger.llm import blocks, lm_scoring

PATH = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"


def brute_lattice(word, units, stop):
    """log of the sum over all segmentations, in plain floating point where that holds, else in logs."""
    text, reach = b" " + word, max(map(len, units))
    ways = [-math.inf] * (len(text) + 1)
    ways[0] = 0.0
    for j in range(1, len(text) + 1):
        found = [ways[i] + math.log(units[text[i:j]]) for i in range(max(0, j - reach), j) if text[i:j] in units]
        top = max(found)
        ways[j] = top + math.log(sum(math.exp(f - top) for f in found))
    return ways[-1] + math.log(stop)


def all_cuts(word, units):
    """Probability of every segmentation, one by one."""
    if not word:
        return [1.0]
    return [units[word[:n]] * p for n in range(1, len(word) + 1) if word[:n] in units for p in all_cuts(word[n:], units)]


@pytest.fixture(scope="module")
def lattice():
    units, prior = lm_scoring.vocabulary_units(PATH)
    return lm_scoring.Lattice(tuple(units), prior * 0.75, 0.25), dict(zip(units, prior * 0.75, strict=True))


def test_every_segmentation_counts(lattice):
    model, units = lattice
    for word in (b"a", b"hello", "é😀".encode(), b"\x00\xff", b"theonin"):
        want = sum(all_cuts(b" " + word, units)) * 0.25
        assert math.isclose(math.exp(model.marginals([word])[0]), want, rel_tol=1e-9)
    assert math.isclose(sum(units.values()), 0.75)


def test_long_words_by_stretches(lattice, monkeypatch):
    model, units = lattice
    words = [b"theantion" * 30, b"x" * 500, "ünï".encode() * 77, b"a"]
    want = [brute_lattice(w, units, 0.25) for w in words]
    assert model.marginals(words) == pytest.approx(want)
    monkeypatch.setattr(lm_scoring, "STRETCH", 60)
    monkeypatch.setattr(lm_scoring, "BATCH", 100)
    assert model.marginals(words) == pytest.approx(want)


def test_expected_counts(lattice):
    """Against the counts of all segmentations, each by its share."""
    model, units = lattice
    word = b"inthe"

    def cuts(rest):
        if not rest:
            return [([], 1.0)]
        return [([rest[:n], *c], units[rest[:n]] * p) for n in range(1, len(rest) + 1) if rest[:n] in units
                for c, p in cuts(rest[n:])]

    found = cuts(b" " + word)
    total = sum(p for _, p in found)
    want = Counter()
    for cut, p in found:
        for unit in cut:
            want[unit] += p / total
    got = dict(zip(units, model.expected([word]), strict=True))
    assert all(math.isclose(got[u], want[u], abs_tol=1e-9) for u in units)


def brute(rows, rounds, by_hand=True):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score of every row."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t in rows]
    held = [zlib.crc32(str("null" if i is None else i).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for words, h in zip(split, held, strict=True) if not h for w in words)
    ends = held.count(False)
    total, types = sum(counts.values()) + ends, len(counts) + (ends > 0)
    n1, n2 = (sum(c == k for c in counts.values()) for k in (1, 2))
    d = min(max(n1 / (n1 + 2 * n2), 0.1), 0.9) if n1 else 0.5
    units, prior = lm_scoring.vocabulary_units(PATH)
    now, stop = prior * 0.75, 0.25
    words = [w.encode() for w in counts]
    for _ in range(rounds if words else 0):
        weight = lm_scoring.PRIOR * prior + lm_scoring.Lattice(tuple(units), now, stop).expected(words)
        stop = (len(words) + 0.25 * lm_scoring.PRIOR) / (weight.sum() + len(words) + 0.25 * lm_scoring.PRIOR)
        now = weight / weight.sum() * (1 - stop)
    by_unit, different = dict(zip(units, now, strict=True)), sorted({w for ws in split for w in ws})
    logs = [brute_lattice(w.encode(), by_unit, stop) for w in different] if by_hand else \
        lm_scoring.Lattice(tuple(units), now, stop).marginals([w.encode() for w in different])
    spelt = {w: x + math.log(1 - lm_scoring.END) for w, x in zip(different, logs, strict=True)}
    share = d * types / total if total else 1.0
    out = []
    for (i, _), ws, h in zip(rows, split, held, strict=True):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in ws)
        base += math.log10((ends + 0.1) / (total + 0.1 * (types + 1)))
        score = sum(math.log10(max(counts[w] - d, 0) / max(total, 1) + share * math.exp(spelt[w])) for w in ws)
        score += math.log10(max(ends - d, 0) / max(total, 1) + share * lm_scoring.END)
        lattice_score = sum(spelt[w] for w in ws) / math.log(10) + math.log10(lm_scoring.END)
        out.append((i, h, len(ws) + 1, sum(w in counts for w in ws) + (ends > 0), total, base, score, lattice_score))
    return out


def compared(got, want):
    key = lambda r: tuple(str(round(x, 3)) if isinstance(x, float) else str(x) for x in r)
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-7)


def test_edge_rows(make_docs, edge_rows):
    """Nulls, empty, blank and very long texts, repeated rows and ids, clashing columns."""
    edge_rows = [(i, t if t is None or len(t) < 10_000 else t[:10_000] + " end") for i, t in edge_rows]
    want = brute(edge_rows, 2)
    clashing = make_docs(edge_rows).withColumns({n: F.lit("mine") for n in ("key", "block", "held", "c", "score", "id", "place")})
    compared(lm_scoring.score_documents(clashing, PATH).collect(), want)


def test_no_training_rows_and_empty_tables(make_docs):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:5]
    rows = [(i, "one two Two") for i in held] + [(held[0], None)]
    compared(lm_scoring.score_documents(make_docs(rows), PATH).collect(), brute(rows, 2))
    assert lm_scoring.score_documents(make_docs(rows).limit(0), PATH).collect() == []


def test_whole_table_by_small_blocks(spark, make_docs):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows, 2, by_hand=False)
    compared(lm_scoring.score_documents(docs, PATH, block_bytes=30_000).collect(), want)
    table = [r for r in want if r[1]]
    # Held out: the lattice with whole words tells more than pieces alone.
    assert sum(r[6] for r in table) > sum(r[7] for r in table)


def test_pack():
    import numpy as np
    a, b = blocks.unpack(blocks.pack(np.arange(5), np.array([], bool)))
    assert a.tolist() == [0, 1, 2, 3, 4] and b.tolist() == []


def test_short_words_need_no_logs(lattice, monkeypatch):
    """Plain numbers where they hold the probability, logs for the rest, with equal sums."""
    model, units = lattice
    rare = min((u for u in units if len(u) == 1), key=units.get)
    short, odd = [b"a", b"hello", "é😀".encode(), b"theonin" * 3, b"\x00\xff"], [rare * 100, b"theantion" * 40]
    want = [brute_lattice(w, units, 0.25) for w in short + odd]
    assert want[-2] < math.log(lm_scoring.LEAST)
    apart = model._expected(short + odd)
    assert model.marginals(odd + short) == pytest.approx(want[-2:] + want[:-2])
    assert model.expected(odd + short) == pytest.approx(apart, abs=1e-12)
    monkeypatch.setattr(lm_scoring.Lattice, "_forward", lambda *_: pytest.fail("taken by logs"))
    assert model.marginals(short) == pytest.approx(want[:-2])
    assert model.expected(short).sum() > 0


def test_words_at_blanks_of_the_contract(monkeypatch):
    import pyarrow as pa
    texts = [*(f"A{chr(c)}b{chr(c)}" for c in [*range(1, 200), 0x2003, 0x3000, 0xFEFF]), None, "", " \t", "É  Z\n"]
    words, counts = lm_scoring.words_of(pa.array(texts, pa.string()))
    split = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for t in texts]
    assert words.to_pylist() == [w for ws in split for w in ws] and counts.tolist() == [len(ws) for ws in split]
    monkeypatch.setattr(lm_scoring, "TEXT_STRETCH", 7)
    text = "é one\x0btwo  threefourfive\n" * 5 + "x" * 30
    cut = list(lm_scoring.stretches(text))
    assert len(cut) > 5 and "".join(cut) == text
    assert lm_scoring.words_of(pa.array(cut))[0].to_pylist() == text.split()


def test_text_longer_than_a_stretch(make_docs):
    rows = [(1, "one Two\vthree é\n" * 90_000), (2, "one"), (3, None), (50, "two four")]
    compared(lm_scoring.score_documents(make_docs(rows), PATH).collect(), brute(rows, 2, by_hand=False))


def test_rows_reach_python_without_lists_sorted_by_one_number(make_docs):
    """A null list costs as much as the batch has rows, and a second sort column a comparison of rows."""
    plan = lm_scoring.score_documents(make_docs([(1, "one"), (2, "two")]), PATH)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "MapInArrow":
        plan = plan.children().head()
    sort = plan.children().head()
    assert sort.nodeName() == "Sort" and sort.order().size() == 1
    assert "ArrayType" not in sort.schema().toString()
