import functools
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from careledger.llm import alignment

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
ODD = ["▁", "a ▁b", "x▁ y", "<|endoftext|> <s> </s><unk>", "  two", "one  two   three ", "a\t b", "a\n \nb", "a \n b", "\n", " ",
       "　 　x", "a  b", "ﬁ ½ é é", "\x00 \x1c z", "don't we'll I'M", "日本語 中文 😀😀 ไทย", "1234567890 12.5",
       "a" * 3000, "ab " * 4000, "x y " * 200 + " end", "​ ﻿", "A<0x41>", "\r\n\r\n", "tab\tin side"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


@pytest.fixture(scope="module")
def encoder():
    return alignment.Encoder(alignment.Pair.read(A_PATH, B_PATH))


@functools.lru_cache(1)
def letters():
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(rest)}}


def brute_tokens(text, libraries):
    """(A ids, B ids, A ends, B ends), None where a tokenizer changes the text."""
    a, b = libraries
    if not text:
        return None
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text)
    a_bytes = [bytes(letters()[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in b_ids]
    want = (" " + text).encode()
    if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return None
    return a_ids, b_ids, np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()


def brute(rows, libraries):
    """The report, pair by pair."""
    found = []
    for _, text in rows:
        got = brute_tokens(text, libraries)
        if got is None:
            found.append(None)
            continue
        a, b, a_ends, b_ends = got
        a_from, b_from = [0, *a_ends[:-1]], [0, *b_ends[:-1]]
        links, j0 = [], 0
        for i in range(len(a)):
            while b_ends[j0] <= a_from[i]:
                j0 += 1
            j = j0
            while j < len(b) and b_from[j] < a_ends[i]:
                links.append((a[i], b[j]))
                j += 1
        groups, low = [], 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            groups.append(",".join(str(x) for x, s, e in zip(a, a_from, a_ends) if s >= low and e <= cut) + "|"
                          + ",".join(str(x) for x, s, e in zip(b, b_from, b_ends) if s >= low and e <= cut)
                          if len(a) < 300 else None)
            low = cut
        if len(a) >= 300:                               # the same by two pointers
            groups, i, j = [], 0, 0
            for cut in sorted(set(a_ends) & set(b_ends)):
                x, y = a_ends.index(cut, i) + 1, b_ends.index(cut, j) + 1
                groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
                i, j = x, y
        found.append((len(a), len(b), groups, links))
    counts = Counter(pair for f in found if f for pair in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _), f in zip(rows, found, strict=True):
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((i, f[0], f[1], len(f[2]), len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]),
                        sum(counts[p] for p in f[3]), hashlib.sha256(";".join(f[2]).encode()).hexdigest()))
    return out


def check_encoder(encoder, libraries, texts):
    a, n_a, b, n_b = encoder.encode(texts)
    for k, text in enumerate(texts):
        want = brute_tokens(text, libraries) or ([], [], [], [])
        x, y = int(n_a[:k].sum()), int(n_b[:k].sum())
        assert a[x:x + n_a[k]].tolist() == want[0], repr(text)
        assert b[y:y + n_b[k]].tolist() == want[1], repr(text)


def test_tokens_of_odd_texts(encoder, libraries):
    assert encoder.cuttable
    check_encoder(encoder, libraries, ODD + ["", "plain"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ab\n\t'’é1.,▁　 😀"), st.characters(exclude_categories=["Cs"])),
                        max_size=40), max_size=4))
def test_tokens_of_any_text(encoder, libraries, texts):
    check_encoder(encoder, libraries, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 9), min_size=1, max_size=30), st.lists(st.integers(1, 9), min_size=1, max_size=30)),
                min_size=1, max_size=5), st.integers(1, 40))
def test_lockstep_against_all_pairs(docs, lane):
    a_ends, b_ends, bounds = [], [], [0]
    for a, b in docs:
        short, long = sorted((a, b), key=sum)
        short[-1] += sum(long) - sum(short)
        a_ends += (np.cumsum(a) + bounds[-1]).tolist()
        b_ends += (np.cumsum(b) + bounds[-1]).tolist()
        bounds.append(bounds[-1] + sum(a))
    a_from, b_from = [0, *a_ends[:-1]], [0, *b_ends[:-1]]
    want = {(i, j) for i in range(len(a_ends)) for j in range(len(b_ends))
            if max(a_from[i], b_from[j]) < min(a_ends[i], b_ends[j])}
    i, j, a_cut, b_cut = alignment.lockstep(np.array(a_ends), np.array(b_ends), np.array(bounds), lane)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted(want)
    cuts = set(a_ends) & set(b_ends)
    assert a_cut.tolist() == [e in cuts for e in a_ends] and b_cut.tolist() == [e in cuts for e in b_ends]


def test_edge_rows(make_docs, edge_rows, libraries):
    """Nulls, empty, odd and very long texts, repeated rows and ids, clashing columns."""
    rows = edge_rows + list(enumerate(ODD, 100))
    docs = make_docs(rows).withColumns({n: F.lit("mine") for n in ("key", "block", "place", "c", "best", "n_a", "a", "ids")})
    got = alignment.alignment_report(docs, alignment.Pair.read(A_PATH, B_PATH), block_bytes=5000)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows, libraries)))


def test_whole_table(spark, libraries):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pair = alignment.Pair.read(A_PATH, B_PATH)
    assert sorted(map(tuple, alignment.alignment_report(docs, pair).collect())) == sorted(brute(rows, libraries))
    want = {i: brute_tokens(t, libraries) for i, t in rows}
    for r in alignment.aligned_documents(docs, pair).collect():
        a, b, a_ends, b_ends = want[r.doc_id] or ([], [], [], [])
        assert (list(r.a_ids), list(r.b_ids)) == (a, b) and (sum(r.a_sizes), sum(r.b_sizes)) == (len(a), len(b))
        cuts = sorted(set(a_ends) & set(b_ends))
        assert [a_ends[k - 1] for k in np.cumsum(r.a_sizes).tolist()] == cuts
        assert [b_ends[k - 1] for k in np.cumsum(r.b_sizes).tolist()] == cuts


def test_empty_table(make_docs):
    assert alignment.alignment_report(make_docs([(1, "a")]).limit(0), alignment.Pair.read(A_PATH, B_PATH)).collect() == []
