import base64
import sys

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from careledger.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_edge_rows_round_trip(make_docs, edge_rows, reference):
    docs = make_docs(edge_rows)
    got = bpe.bpe_encode(docs, PATH, public_tokenizers.PATTERN, decoded_col="n_chars").collect()
    assert len(got) == len(edge_rows)
    for r in got:
        assert list(r.ids) == reference.encode_ordinary(r.text or "")
        assert bytes(r.n_chars) == (r.text or "").encode()
    back = bpe.bpe_decode(bpe.bpe_encode(docs, PATH, public_tokenizers.PATTERN).select("text", "ids"), PATH)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())


def test_every_kind_of_character(reference):
    encoder = bpe.Encoder(bpe.vocabulary(PATH), public_tokenizers.PATTERN)
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 50_000):
        text = "".join(f" {chr(c)}{chr(c)}a1" for c in points[a:a + 50_000])
        ids, _ = encoder.encode([text])
        assert ids.tolist() == reference.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcdeé 's\n\t12,.😀"), st.characters(exclude_categories=["Cs"])),
                        max_size=60), max_size=5))
def test_any_text(reference, texts):
    vocab = bpe.vocabulary(PATH)
    ids, counts = bpe.Encoder(vocab, public_tokenizers.PATTERN).encode(texts)
    want = [reference.encode_ordinary(t) for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
    assert vocab.decode(ids) == "".join(texts).encode()


@pytest.mark.parametrize("length", [1, 2, 1023, 1024, 1025, 5000])
def test_long_pieces(reference, length):
    """Up to ``WIDE`` bytes by matrix, beyond by heap: the same merges."""
    encoder = bpe.Encoder(bpe.vocabulary(PATH), public_tokenizers.PATTERN)
    for unit in ("a", "the", "é", " ", "xyzzy"):
        text = (unit * length)[:length]
        assert encoder.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_blocks_and_forgetting(reference, monkeypatch, words):
    monkeypatch.setattr(bpe, "BLOCK", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    texts = [words(1, 2000), "", words(2, 10), words(1, 300)]
    ids, counts = bpe.Encoder(bpe.vocabulary(PATH), public_tokenizers.PATTERN).encode(texts)
    want = [reference.encode_ordinary(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_ids_outside_the_vocabulary_raise():
    import numpy as np
    with pytest.raises(ValueError):
        bpe.vocabulary(PATH).decode(np.array([10 ** 6]))


def test_null_ids_and_empty_table(make_docs, spark):
    null = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.bpe_decode(null, PATH).first().decoded) == b""
    assert bpe.bpe_encode(make_docs([]), PATH, public_tokenizers.PATTERN).count() == 0
