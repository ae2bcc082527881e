"""Operator 10, byte-level BPE encoding and decoding in length-bucketed numpy matrices.

A text is cut by the tokenizer's pattern; each different piece is encoded once
and remembered.  New pieces of similar length share a padded matrix of token
ids.  In every round each row merges its leftmost pair of minimum rank; pair
ranks come from a hashed table with linear probing; rows shrink by one column a
round (compaction), and rows without a mergeable pair leave the matrix.  Pieces
over ``WIDE`` bytes would cost the square of their length there; they take the
same merges from a heap instead, with the same result.

Work is map-only: texts stream through the tasks in slices of about a million
characters, and a text longer than that in blocks of pieces, so a task's memory
does not grow with a text beyond its own ids.

Defined results: a null or empty text has no ids (an empty list) and decodes to
no bytes; a null list of ids decodes to no bytes; an id outside the vocabulary
raises.  Special tokens are ordinary text.  Other columns pass through; columns
named like the outputs are replaced.  Repeated rows are encoded one by one; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from careledger.llm.common import length_slices, mixed

NEVER = np.int32(2**31 - 1)
WIDE = 1024                 # bytes of a piece up to which matrices are used
CELLS = 1 << 20             # cells of one matrix at most
BLOCK = 200_000             # pieces of a long text that are held at once
REMEMBERED = 200_000        # pieces a task remembers

#: Code points that are no letters or numbers in Unicode 16, which the tokenizer's pattern goes by,
#: but are in later versions, which the regex library may know (first and last of each range).
LATER = """
0558-0558 058B-058C 088F-088F 0C5C-0C5C 0CDC-0CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 A7D4-A7D4 A7DD-A7DD
A7E2-A7E2 A7F1-A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DE0-11DE9
11DF1-11DF1 1246F-1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168-1B168 1D6A6-1D6A6 1DF1F-1DF24 1DF2B-1DF81
1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F
2B81E-2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
_LATER = "[" + "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in LATER.split()) + "]"


class Vocabulary:
    """Ranks of a byte-level BPE: pair table for encoding, byte table for decoding."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.first = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self._hash(np.fromiter(pairs, np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        size = max(ranks.values()) + 1
        words = [b""] * size
        for token, rank in ranks.items():
            words[rank] = token
        self.width = np.fromiter(map(len, words), np.int64, size)
        self.start = np.cumsum(self.width) - self.width
        self.bytes = np.frombuffer(b"".join(words), np.uint8)

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.mask = np.uint64((1 << (2 * len(keys)).bit_length()) - 1)
        self.keys = np.full(int(self.mask) + 1, 2**64 - 1, np.uint64)
        self.ranks = np.full(int(self.mask) + 1, NEVER, np.int32)
        slots, self.probes = mixed(keys) & self.mask, 0
        while len(keys):
            free = self.keys[slots] == np.uint64(2**64 - 1)
            _, winner = np.unique(slots, return_index=True)
            put = np.zeros(len(keys), bool)
            put[winner] = True
            put &= free
            self.keys[slots[put]], self.ranks[slots[put]] = keys[put], values[put]
            keys, values, slots = keys[~put], values[~put], (slots[~put] + np.uint64(1)) & self.mask
            self.probes += 1

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each (left, right) pair merges into, ``NEVER`` where none (or padding, -1)."""
        keys = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | right.astype(np.int64).astype(np.uint64)
        wanted = keys.ravel()
        slots = mixed(wanted) & self.mask
        there = self.keys[slots]
        flat = np.where(there == wanted, self.ranks[slots], NEVER)
        open_ = np.flatnonzero((there != wanted) & (there != np.uint64(2**64 - 1)))
        slots = slots[open_]
        while len(open_):
            slots = (slots + np.uint64(1)) & self.mask
            hit, empty = self.keys[slots] == wanted[open_], self.keys[slots] == np.uint64(2**64 - 1)
            flat[open_[hit]] = self.ranks[slots[hit]]
            go = ~(hit | empty)
            open_, slots = open_[go], slots[go]
        flat = np.where((left.ravel() < 0) | (right.ravel() < 0), NEVER, flat)
        return flat.reshape(left.shape)

    def merge_matrix(self, ids: np.ndarray) -> list[np.ndarray]:
        """Final ids of each row of a matrix padded with -1 on the right."""
        out: list[np.ndarray] = [ids[:0, 0]] * len(ids)
        ranks, who = self.pair_ranks(ids[:, :-1], ids[:, 1:]), np.arange(len(ids))
        while len(ids):
            best = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            rows = np.arange(len(ids))
            low = ranks[rows, best] if ranks.shape[1] else np.full(len(ids), NEVER)
            done = low == NEVER
            for k in np.flatnonzero(done):
                out[who[k]] = ids[k][ids[k] >= 0]
            if done.any():
                ids, ranks, who, best, low = ids[~done], ranks[~done], who[~done], best[~done], low[~done]
                rows = np.arange(len(ids))
            if not len(ids):
                break
            ids[rows, best] = low
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > best[:, None]), 1)
            cols = np.arange(ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, cols + (cols >= best[:, None]), 1)
            if ranks.shape[1]:
                for shift in (-1, 0):
                    at = best + shift
                    ok = (at >= 0) & (at < ranks.shape[1])
                    ranks[rows[ok], at[ok]] = self.pair_ranks(ids[rows[ok], at[ok]], ids[rows[ok], at[ok] + 1])
        return out

    def merge_wide(self, ids: np.ndarray) -> np.ndarray:
        """The same merges for one long piece: a heap of (rank, place) over a linked list."""
        ranks = self.pair_ranks(ids[:-1], ids[1:])
        heap = [(int(r), i) for i, r in enumerate(ranks) if r != NEVER]
        heapq.heapify(heap)
        tokens, after, before = ids.tolist(), list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        now, memo = ranks.tolist() + [int(NEVER)], {}

        def rank(a: int, b: int) -> int:
            if (a, b) not in memo:
                memo[a, b] = int(self.pair_ranks(np.array([a]), np.array([b]))[0])
            return memo[a, b]

        while heap:
            r, i = heapq.heappop(heap)
            if now[i] != r:
                continue
            j = after[i]
            tokens[i], tokens[j], now[j] = r, -1, int(NEVER)
            after[i] = after[j]
            if after[i] < len(tokens):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0:
                    now[k] = rank(tokens[k], tokens[after[k]]) if after[k] < len(tokens) else int(NEVER)
                    if now[k] != NEVER:
                        heapq.heappush(heap, (now[k], k))
        return np.array([t for t in tokens if t >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        buckets = np.where(sizes <= 4, sizes, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        for width in np.unique(buckets):
            members = np.flatnonzero(buckets == width)
            if width > WIDE:
                for k in members:
                    out[k] = self.merge_wide(self.first[np.frombuffer(pieces[k], np.uint8)])
                continue
            for part in range(0, len(members), max(1, CELLS // int(width))):
                rows = members[part:part + max(1, CELLS // int(width))]
                matrix = np.full((len(rows), int(width)), -1, np.int32)
                fill = np.arange(int(width)) < sizes[rows][:, None]
                matrix[fill] = self.first[np.frombuffer(b"".join(pieces[k] for k in rows), np.uint8)]
                for k, ids in zip(rows, self.merge_matrix(matrix), strict=True):
                    out[k] = ids
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= len(self.width)):
            raise ValueError("an id is outside the vocabulary")
        if len(ids) and not self.width[ids].all():
            raise ValueError("an id has no token")
        return self.bytes[_runs(self.start[ids], self.width[ids])].tobytes()


def _runs(starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after the other."""
    return np.repeat(starts - (np.cumsum(widths) - widths), widths) + np.arange(int(widths.sum()))


@functools.lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder(dict):
    """Piece -> number of a remembered piece; its ids lie in one flat array."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        super().__init__()
        self.vocab, self.pattern, self.new = vocab, regex.compile(pattern), []
        # Texts with later characters, which are rare, go by a pattern that takes them out of the classes.
        self.later = regex.compile(_LATER)
        self.strict = regex.compile(pattern.replace("\\p{L}", f"[\\p{{L}}--{_LATER}]").replace(
            "\\p{N}", f"[\\p{{N}}--{_LATER}]"), regex.V1)
        self.flat, self.start, self.width = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = number = len(self)
        return number

    def _learn(self) -> None:
        if self.new:
            ids = self.vocab.encode_pieces([p.encode("utf-8") for p in self.new])
            width = np.fromiter(map(len, ids), np.int64, len(ids))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(width) - width])
            self.width = np.concatenate([self.width, width])
            self.flat = np.concatenate([self.flat, *ids])
            self.new = []

    def _blocks(self, text: str) -> Iterator[list[str]]:
        pattern = self.strict if not text.isascii() and self.later.search(text) else self.pattern
        if len(text) <= 4 * BLOCK:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while block := list(islice(found, BLOCK)):
            yield block

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        parts, counts, numbers = [], [], []

        def flush() -> None:
            self._learn()
            n = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
            parts.append(self.flat[_runs(self.start[n], self.width[n])])
            at = 0
            for k, x in zip(owners, numbers, strict=True):
                counts[k] += int(self.width[n[at:at + len(x)]].sum())
                at += len(x)
            numbers.clear(), owners.clear()
            if len(self) > REMEMBERED:
                self.clear()
                self.flat, self.start, self.width = self.flat[:0], self.start[:0], self.width[:0]

        owners: list[int] = []
        held = 0
        for k, text in enumerate(texts):
            counts.append(0)
            for block in self._blocks(text):
                numbers.append(np.fromiter(map(self.__getitem__, block), np.int64, len(block)))
                owners.append(k)
                held += len(block)
                if held >= BLOCK:
                    flush()
                    held = 0
        flush()
        return np.concatenate(parts), np.array(counts, np.int64)


def _with(df: DataFrame, fields: list[T.StructField]) -> tuple[list[str], T.StructType]:
    new = {f.name for f in fields}
    keep = [f for f in df.schema.fields if f.name not in new]
    return [f.name for f in keep], T.StructType([*keep, *fields])


def _batch(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in keep), *new.values()],
                                      names=[*keep, *new])


def bpe_encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
               decoded_col: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text_col``; with ``decoded_col`` also what the ids decode to,
    in the same pass.  ``path`` is a rank file that every executor can open."""
    fields = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)]
    fields += [T.StructField(decoded_col, T.BinaryType(), False)] if decoded_col else []
    keep, schema = _with(df, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        encoder = Encoder(vocab, pattern)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col))
            for a, b in length_slices(text):
                ids, counts = encoder.encode([t or "" for t in text.slice(a, b - a).to_pylist()])
                ends = np.concatenate([[0], np.cumsum(counts)])
                new = {ids_col: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))}
                if decoded_col:
                    new[decoded_col] = pa.array([vocab.decode(ids[x:y]) for x, y in zip(ends, ends[1:])], pa.binary())
                yield _batch(batch.slice(a, b - a), keep, new)

    return df.mapInArrow(run, schema)


def bpe_decode(df: DataFrame, path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids of ``ids_col`` stand for."""
    keep, schema = _with(df, [T.StructField(decoded_col, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_col))
            out = [vocab.decode(np.asarray(x.values) if x.is_valid else np.empty(0, np.int32)) for x in column]
            yield _batch(batch, keep, {decoded_col: pa.array(out, pa.binary())})

    return df.mapInArrow(run, schema)
