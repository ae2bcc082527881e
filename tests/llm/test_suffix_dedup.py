import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from careledger.llm import induced_sort, suffix_dedup


def brute(rows, width=50):
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - width + 1):
            if doc is not None:
                k = raw[p:p + width]
                first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            if doc is not None and first[raw[p:p + width]] < doc:
                gone[p:p + width] = b"\1" * width
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(make_docs, rows, width=50):
    got = suffix_dedup.remove_repeats(make_docs(rows, 5), width).collect()
    mine = [(r.id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got]
    assert sorted(mine, key=str) == brute(rows, width)


def test_edge_rows(make_docs, edge_rows):
    rows = [(d, t[:9000] if t else t) for d, t in edge_rows]
    check(make_docs, rows)


@pytest.mark.parametrize("shard_bytes,piece,held", [(2 << 20, 1 << 16, 4 << 20), (3000, 1 << 16, 2000), (500, 1 << 10, 300)])
def test_passages_copies_and_runs(make_docs, words, monkeypatch, shard_bytes, piece, held):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "HELD", held)
    rng = random.Random(2)
    passages = [words(("p", i), n) for i, n in enumerate((9, 10, 11, 12, 40, 200))] + ["z" * 120, "ab" * 60, "é😀" * 30]
    rows = []
    for i in range(60):
        parts = [words(("own", i, k), rng.randint(0, 20)) for k in range(3)]
        rows.append(" ".join(x for k in range(3) for x in (parts[k], rng.choice(passages)[rng.randint(0, 5):])))
    rows += [rows[3], rows[3], rows[7] + "!", "z" * 49, "z" * 50, "z" * 51]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    check(make_docs, list(zip(ids, rows)))


def test_long_text_in_pieces(make_docs, words, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    long = words(1, 3000)
    check(make_docs, [(1, long), (0, long[4000:4200]), (2, "x" + long[900:1100] + "y")])


def test_other_width_and_empty_table(make_docs, words):
    check(make_docs, [(1, words(1, 20)), (2, words(1, 20)[10:60])], 20)
    assert suffix_dedup.remove_repeats(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(make_docs([]), 5)


def _jobs(spark, work):
    """How many Spark jobs ``work`` starts."""
    name = f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_jobs_do_not_grow_with_shards(spark, make_docs, words, monkeypatch):
    rows = [(i, words(i % 30, 60)) for i in range(60)]
    jobs = []
    for shard_bytes in (1 << 20, 300):
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
        jobs.append(_jobs(spark, lambda: suffix_dedup.remove_repeats(make_docs(rows)).collect()))
    assert jobs[0] == jobs[1]
    check(make_docs, rows)


def test_many_shards_in_few_partitions(make_docs, words, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 200)
    monkeypatch.setattr(suffix_dedup, "TASK_BYTES", 1 << 30)
    passage = words("shared", 30)
    check(make_docs, [(i, f"{words(('a', i), 12)} {passage} {words(('b', i), 12)}") for i in range(50)])


def test_short_phrases_do_not_make_stretches_meet(words):
    """Texts that share phrases of 16 to 18 bytes and no 50-byte string have no anchor in common."""
    phrases = [words(("phrase", i), 12)[:16 + i % 3] for i in range(40)]
    seen, met = set(), 0
    for i in range(30):
        raw = "".join(f"{words((i, p), 8)}{p}" for p in phrases).encode()
        anchors = set(suffix_dedup.stretches([raw], 50)[2].tolist())
        met += len(anchors & seen)
        seen |= anchors
    assert met == 0


def by_shard(rows, width=50):
    """What ``brute`` gives, from one shard that holds all stretches of the rows."""
    shard = suffix_dedup._Shard(0, width)
    for doc, text in rows:
        raw = text.encode()
        at, count, _ = suffix_dedup.stretches([raw], width)
        size = count + width - 1
        cut = b"".join(raw[a:a + n] for a, n in zip(at.tolist(), size.tolist()))
        lists = (pa.array([c], pa.list_(k))[0] for c, k in (
            ([doc] * len(at), pa.int64()), ([0] * len(at), pa.int64()), (at, pa.int32()), (size, pa.int32())))
        assert shard.add(*lists, pa.array([pa.compress(cut, "zstd", asbytes=True)], pa.binary())[0]) is None
    gone = {doc: bytearray(len(text.encode())) for doc, text in rows}
    for batch in shard.ranges():
        for r in batch.to_pylist():
            gone[r["id"]][r["start"]:r["stop"]] = b"\1" * (r["stop"] - r["start"])
    out = []
    for doc, text in rows:
        raw, g = text.encode(), gone[doc]
        kept = bytes(b for b, x in zip(raw, g) if not x)
        out.append((doc, len(raw), sum(g), sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1])),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture
def sorted_bytes(monkeypatch):
    """The sizes of the texts whose suffixes are sorted."""
    sizes, covered = [], suffix_dedup._covered
    monkeypatch.setattr(suffix_dedup, "_covered", lambda strings, *a: sizes.append(sum(map(len, strings))) or covered(strings, *a))
    return sizes


def test_texts_around_one_passage_are_not_sorted_one_by_one(words, sorted_bytes):
    passage = words("shared", 40)
    rows = [(i, f"{words(('a', i), 9)}{chr(0x4E00 + i)}{passage}{chr(0x4E00 + i)}{words(('b', i), 9)}") for i in range(60)]
    random.Random(4).shuffle(rows)
    assert by_shard(rows) == brute(rows)
    assert sum(sorted_bytes) <= 2 * len(passage)


@pytest.mark.parametrize("width", [20, 50, 67])
def test_overlaps_of_every_length_are_sorted(words, sorted_bytes, width):
    rng = random.Random(width)
    passages = [words(("p", i), 60) for i in range(3)] + ["z" * 200, "ab" * 90, "abc" * 70 + words("q", 20)]
    rows = []
    for i in range(120):
        p = rng.choice(passages)
        a = rng.randint(0, 60)
        rows.append((i, words(("own", i), rng.randint(0, 8)) + p[a:a + rng.randint(width, 120)] + words(("end", i), rng.randint(0, 8))))
    rng.shuffle(rows)
    assert by_shard(rows, width) == brute(rows, width)
    assert sum(sorted_bytes) > 0


def test_spans_are_taken_in_order_whatever_their_sizes(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 10)
    rng = np.random.default_rng(3)
    flat = rng.integers(0, 256, 500).astype(np.uint8)
    for count in (0, 1, 40):
        begin, size = rng.integers(0, 400, count), rng.integers(0, 40, count)
        want = [flat[a:a + n] for a, n in zip(begin, size)]
        assert suffix_dedup._spans(flat, begin, size).tolist() == np.concatenate([np.empty(0, np.uint8), *want]).tolist()


@pytest.mark.parametrize("block,budget", [(1 << 20, 1 << 20), (4, 10)])
def test_induced_sort_orders_suffixes_and_counts_prefixes(monkeypatch, tmp_path, block, budget):
    """With tiny blocks and budgets the queues go to disk; the result is the same."""
    monkeypatch.setattr(induced_sort, "BLOCK", block)
    rng = np.random.default_rng(1)
    for trial in range(60):
        symbols = int(rng.integers(1, 6))
        text = rng.integers(1, symbols + 1, int(rng.integers(1, 300)))
        if trial % 3 == 0:
            text = np.concatenate([text[rng.integers(0, len(text)):][:rng.integers(1, 40)] for _ in range(10)])
        text = np.append(text, 0).astype(np.uint16)
        depth = int(rng.integers(1, 60))
        blocks = list(induced_sort.sorted_suffixes(text, depth, str(tmp_path), budget))
        order, prefix = (np.concatenate(x) for x in zip(*blocks))
        raw = bytes(text.astype(np.uint8))
        assert sorted(order.tolist()) == list(range(len(text)))
        keys = [raw[i:i + depth] for i in order]
        assert keys == sorted(keys)
        for i in range(1, len(order)):
            a, b = raw[order[i - 1]:], raw[order[i]:]
            same = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[i] == min(same, depth)
    assert not list(tmp_path.iterdir())
