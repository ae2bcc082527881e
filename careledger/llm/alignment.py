"""Operator 12, cross-tokenizer alignment by lockstep vectorised merging.

The tokens of two tokenizers lie over the same bytes.  Merging the two lists of
token ends gives every pair of tokens that overlap (links) and every byte where
both have an end (cuts, which split a text into groups).  All documents of a
slice are merged at once: one vector holds an A pointer and a B pointer for
each lane, a step emits the pairs that the pointers stand on, marks cuts and
moves on whichever token ends first (both at a cut), and finished lanes are
compacted away.  A lane is a document, or a stretch of ``LANE`` bytes of a longer
one: it starts on the tokens over its first byte and stops on those over the
next lane's, so a long text takes no more steps than a short one.

Tokens: texts are cut at single blanks, where neither tokenizer's tokens go on,
and a task remembers the tokens of each different stretch; a text where that is
not certain (runs of blanks, U+2581, other rules in the tokenizer's file) is
encoded whole.  Both vocabularies travel with the job.

How many documents hold a pair of ids linked is counted corpus-wide by blocks
(``blocks.py``): a task writes the different pairs of a block once, with their
documents, and gets the counts back for its block alone.

Defined results: a text that is null, empty, or that either tokenizer changes
has no tokens, groups or links (zeros, and '' as digest); rows that repeat an id
are documents of their own; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careledger.llm import blocks as B
from careledger.llm.common import length_slices, stored

LANE = 256              # bytes of a lane
REMEMBERED = 200_000    # stretches of text that a task remembers
MOST_TOKENS = 8 << 20   # tokens of them
_ODD_BLANKS = re.compile(r"[^\S ] [^\S ]")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(rest)}}


@dataclass(frozen=True)
class Pair:
    """The two tokenizers' files: a byte-level JSON vocabulary (A) and a piece model (B)."""
    a_json: str
    b_model: bytes

    @staticmethod
    def read(a_path: str, b_path: str) -> Pair:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return Pair(a.read(), b.read())


class _Bytes:
    """What the ids of a vocabulary stand for."""

    def __init__(self, tokens: list[bytes]):
        self.width = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.width) - self.width
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        return self.flat[_runs(self.start[ids], self.width[ids])].tobytes()


def _runs(starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after the other."""
    return np.repeat(starts - (np.cumsum(widths) - widths), widths) + np.arange(int(widths.sum()))


class Encoder(dict):
    """Stretch of text -> number of a remembered stretch; its A and B ids lie in two flat arrays."""

    def __init__(self, pair: Pair):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(pair.a_json), sentencepiece.SentencePieceProcessor(model_proto=pair.b_model)
        self.a.encode_special_tokens = True
        vocabulary, letters = self.a.get_vocab(with_added_tokens=True), _byte_letters()
        special = {t["content"] for t in json.loads(pair.a_json)["added_tokens"]}
        a_tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_tokens[i] = token.encode("utf-8") if token in special else bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = _Bytes(a_tokens)
        self.b_bytes = _Bytes([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                               for i, p in enumerate(pieces)])
        self.cuttable = self._cuttable(json.loads(pair.a_json), pieces)
        size = max(len(a_tokens), len(pieces))
        digits = [str(i).encode() for i in range(size)]
        self.n_digits = np.fromiter(map(len, digits), np.int64, size)
        self.digits = np.frombuffer(b"".join(d.ljust(len(str(size)) + 1) for d in digits), np.uint8).reshape(size, -1)
        self._forget()

    @staticmethod
    def _cuttable(rules: dict, pieces: list[str]) -> bool:
        """Whether no token of either goes on over a blank between two words."""
        pre = rules.get("pre_tokenizer") or {}
        return (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                and not rules.get("normalizer") and not any("▁" in p.lstrip("▁") for p in pieces))

    def _forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.good = np.empty(0, bool)
        self.flat = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.start = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.width = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def __missing__(self, stretch: str) -> int:
        self.new.append(stretch)
        self[stretch] = number = len(self)
        return number

    def _learn(self) -> None:
        if not self.new:
            return
        found = ([e.ids for e in self.a.encode_batch_fast([f" {s}" for s in self.new], add_special_tokens=False)],
                 self.b.encode(self.new, num_threads=1))
        want = [f" {s}".encode() for s in self.new]
        good = np.ones(len(want), bool)
        for k, (ids, table) in enumerate(zip(found, (self.a_bytes, self.b_bytes), strict=True)):
            width = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(width.sum()))
            owner = np.repeat(np.arange(len(ids)), width)
            sizes = np.bincount(owner, table.width[flat], len(ids)).astype(np.int64)
            good &= sizes == np.fromiter(map(len, want), np.int64, len(want))
            if table.joined(flat) != b"".join(want):
                good &= np.fromiter((table.joined(np.array(row, np.int64)) == w for row, w in zip(ids, want, strict=True)),
                                    bool, len(want))
            self.start[k] = np.concatenate([self.start[k], len(self.flat[k]) + np.cumsum(width) - width])
            self.width[k] = np.concatenate([self.width[k], width])
            self.flat[k] = np.concatenate([self.flat[k], flat])
        self.good = np.concatenate([self.good, good])
        self.new = []

    def _stretches(self, text: str) -> list[str]:
        if not text:
            return []
        whole = (not self.cuttable or "  " in text or text[0] == " " or text[-1] == " " or "▁" in text
                 or _ODD_BLANKS.search(text))
        return [text] if whole else text.split(" ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids, how many each text has, B ids, how many); none of a text that either tokenizer changes."""
        if len(self) > REMEMBERED or max(map(len, self.flat)) > MOST_TOKENS:
            self._forget()
        cut = [self._stretches(t) for t in texts]
        numbers = np.fromiter(map(self.__getitem__, chain.from_iterable(cut)), np.int64, sum(map(len, cut)))
        self._learn()
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        bad = np.zeros(len(texts), bool)
        for k in np.unique(owner[~self.good[numbers]]).tolist():       # joined, they may still be the text
            mine, want = numbers[owner == k], f" {texts[k]}".encode()
            bad[k] = any(table.joined(self.flat[x][_runs(self.start[x][mine], self.width[x][mine])]) != want
                         for x, table in enumerate((self.a_bytes, self.b_bytes)))
        keep = ~bad[owner]
        numbers, owner = numbers[keep], owner[keep]
        out = []
        for k in range(2):
            out += [self.flat[k][_runs(self.start[k][numbers], self.width[k][numbers])],
                    np.bincount(owner, self.width[k][numbers], len(texts)).astype(np.int64)]
        return tuple(out)


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, bounds: np.ndarray,
             lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge token ends over one axis of bytes, on which documents lie one after the other.

    ``bounds``: where documents begin, and the end of the last.  Returns the places of the A and B tokens of every
    link (in the order of the steps) and, for each A and each B token, whether a cut follows it."""
    a_cut, b_cut = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    sizes = np.diff(bounds)
    lanes = -(-sizes // lane)
    at = np.repeat(bounds[:-1], lanes) + lane * _runs(np.zeros(len(lanes), np.int64), lanes)
    i, j = np.searchsorted(a_ends, at, "right"), np.searchsorted(b_ends, at, "right")
    i_stop, j_stop = np.append(i[1:], len(a_ends)), np.append(j[1:], len(b_ends))
    links: list[tuple[np.ndarray, np.ndarray]] = [(i[:0], j[:0])]
    open_ = (i != i_stop) | (j != j_stop)
    while len(i):
        if not open_.all():
            i, j, i_stop, j_stop = i[open_], j[open_], i_stop[open_], j_stop[open_]
        links.append((i, j))
        left, right = a_ends[i], b_ends[j]
        both = left == right
        a_cut[i[both]], b_cut[j[both]] = True, True
        i, j = i + (left <= right), j + (right <= left)
        open_ = (i != i_stop) | (j != j_stop)
        if not open_.any():
            break
    return np.concatenate([x for x, _ in links]), np.concatenate([x for _, x in links]), a_cut, b_cut


@dataclass
class Aligned:
    """The documents of a slice: ids and counts of both sides, links, cuts."""
    a: np.ndarray
    n_a: np.ndarray
    b: np.ndarray
    n_b: np.ndarray
    a_link: np.ndarray
    b_link: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray

    @property
    def a_doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_a)), self.n_a)

    def group_texts(self, encoder: Encoder) -> Iterator[memoryview]:
        """``a1,a2|b1;a3|b2,b3`` of every document, as bytes."""
        a_group = np.cumsum(self.a_cut) - self.a_cut
        b_group = np.cumsum(self.b_cut) - self.b_cut
        groups = int(self.a_cut.sum())
        a_size, b_size = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        order = np.empty(len(self.a) + len(self.b), np.int64)
        place_a = np.arange(len(self.a)) + (np.cumsum(b_size) - b_size)[a_group]
        place_b = np.arange(len(self.b)) + np.cumsum(a_size)[b_group]
        order[place_a], order[place_b] = self.a, self.b
        mark = np.full(len(order), ord(","), np.uint8)
        mark[place_a[self.a_cut]], mark[place_b[self.b_cut]] = ord("|"), ord(";")
        rows, width = encoder.digits[order], encoder.n_digits[order]
        rows[np.arange(len(rows)), width] = mark
        flat = memoryview(rows[np.arange(rows.shape[1]) <= width[:, None]])
        ends = np.concatenate([[0], np.cumsum(width + 1)])
        bounds = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        for x, y in zip(ends[bounds[:-1]].tolist(), ends[bounds[1:]].tolist(), strict=True):
            yield flat[x:max(y - 1, x)]


def align(encoder: Encoder, texts: list[str]) -> Aligned:
    a, n_a, b, n_b = encoder.encode(texts)
    a_ends, b_ends = np.cumsum(encoder.a_bytes.width[a]), np.cumsum(encoder.b_bytes.width[b])
    bounds = np.concatenate([[0], a_ends])[np.concatenate([[0], np.cumsum(n_a)])]
    return Aligned(a, n_a, b, n_b, *lockstep(a_ends, b_ends, bounds))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str], int]]:
    """(ids, texts, bytes) of about a million bytes."""
    for batch in batches:
        column = batch.column(1)
        for x, y in length_slices(column):
            texts = [t or "" for t in column.slice(x, y - x).to_pylist()]
            yield batch.column(0).slice(x, y - x), texts, sum(map(len, texts)) + 64 * len(texts)


def aligned_documents(docs: DataFrame, pair: Pair) -> DataFrame:
    """One row per row of ``docs``: doc_id, a_ids, b_ids, and how many tokens of each side every group has
    (a_sizes, b_sizes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pair)
        for ids, texts, _ in _slices(batches):
            x = align(encoder, texts)
            out = [ids]
            for tokens, n, cut in ((x.a, x.n_a, x.a_cut), (x.b, x.n_b, x.b_cut)):
                ends = np.concatenate([[0], np.cumsum(n)])
                sizes = np.diff(np.flatnonzero(cut) + 1, prepend=0)
                groups = np.concatenate([[0], np.cumsum(cut)])[ends]
                out += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(groups, pa.int32()), pa.array(sizes, pa.int32()))]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "a_ids", "a_sizes", "b_ids", "b_sizes"])

    lists = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           *(T.StructField(n, lists) for n in ("a_ids", "a_sizes", "b_ids", "b_sizes"))])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _blocks(batches: Iterator[pa.RecordBatch], pair: Pair, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """(id, text) to blocks: pairs of ids with their documents, documents with their links by places of pairs."""
    encoder, numbers = Encoder(pair), B.block_numbers()
    wide = np.int64(len(encoder.b_bytes.width))
    bits = np.int64((len(encoder.a_bytes.width) * int(wide)).bit_length())      # of a pair of ids
    block, facts, parts = B.Block(), [], []

    def flush() -> Iterator[pa.RecordBatch]:
        key = np.concatenate([p[0] for p in parts])
        different = np.unique(key)
        places = np.searchsorted(different, key).astype(np.int32)
        blob = B.pack(pa.concat_arrays(block.ids), np.concatenate(facts),
                      np.concatenate([p[2] for p in parts]).astype(np.int32), places,
                      np.concatenate([p[1] for p in parts]).astype(np.int32))
        yield from B.entry_batches(next(numbers), pa.array(different), np.bincount(places, minlength=len(different)), 0, blob)

    for ids, texts, size in _slices(batches):
        x = align(encoder, texts)
        doc = x.a_doc
        links = np.sort(doc[x.a_link] << bits | (x.a[x.a_link] * wide + x.b[x.b_link]))
        first = np.flatnonzero(np.diff(links, prepend=-1))
        parts.append((links[first] & ((1 << bits) - 1), np.diff(np.append(first, len(links))),
                      np.bincount(links[first] >> bits, minlength=len(texts))))
        digests = b"".join(hashlib.sha256(t).digest() for t in x.group_texts(encoder))
        facts.append(np.column_stack([
            x.n_a, x.n_b, np.bincount(doc[x.a_cut], minlength=len(texts)), np.bincount(doc[x.a_link], minlength=len(texts)),
            np.frombuffer(digests, np.int64).reshape(-1, 4)]))
        block.add(ids, size)
        if block.bytes >= block_bytes:
            yield from flush()
            block, facts, parts = B.Block(), [], []
    if block.docs:
        yield from flush()


def alignment_report(docs: DataFrame, pair: Pair, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    blocks = stored(docs.select("doc_id", "text").mapInArrow(
        functools.partial(_blocks, pair=pair, block_bytes=block_bytes),
        B.block_schema(T.LongType())), "alignment-blocks")
    wide = len(Encoder(pair).b_bytes.width)
    counts = stored(B.entries(blocks).groupBy("key").agg(F.sum("n").alias("c")), "alignment-counts")
    left = F.expr(f"key div {wide}").alias("a")
    best = counts.groupBy(left).agg(F.max("c").alias("most"))
    table = counts.withColumn("a", left).join(best, "a").select("key", "c", (F.col("c") == F.col("most")).alias("best"))
    longs = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = T.StructType([*(T.StructField(n, T.LongType()) for n in longs), T.StructField("groups_sha256", T.StringType())])
    schema["doc_id"].dataType = docs.schema["doc_id"].dataType
    return B.answer(blocks, table, ["c", "best"], _finish, schema)


def _finish(values: list[np.ndarray], ids: pa.Array, blob: tuple[np.ndarray, ...]) -> dict[str, pa.Array]:
    (c, best), (facts, different, places, times) = values, blob
    owner = np.repeat(np.arange(len(facts)), different)
    add: Callable[[np.ndarray], pa.Array] = lambda x: pa.array(
        np.bincount(owner, x, len(facts)).astype(np.int64))
    digests = np.ascontiguousarray(facts[:, 4:]).tobytes()
    return {"doc_id": ids, **{n: pa.array(np.ascontiguousarray(facts[:, k]))
                              for k, n in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            "n_best": add(best[places] * times), "count_sum": add(c[places].astype(np.int64) * times),
            "groups_sha256": pa.array([digests[32 * k:32 * k + 32].hex() if n else "" for k, n in enumerate(facts[:, 0])])}
