"""Operator 11, language-model scores by the likelihood of a subword lattice.

A word (with the blank before it) can be cut into pieces of an existing
vocabulary in many ways.  All of them count: pieces are drawn independently,
with weights that start from the vocabulary's own scores, and a forward
recursion over the lattice of a word's bytes sums over all its segmentations,
for words of similar length side by side.  Its sums are plain numbers; words
whose probability is below ``LEAST`` or that are long take it again in log space.  Byte pieces make every word reachable; pieces that stand for
the same bytes are one unit.

Learning, from the training documents only:

1. ``n`` of every word is counted over the corpus, by blocks (``blocks.py``).
2. Scores of the vocabulary (merge ranks become Zipf weights, log-probabilities
   are taken as they are) are the prior of the units; expected counts of the units
   over all segmentations of every different training word (forward and backward)
   are added to it, ``rounds`` times.
3. A training word as a whole is one more arc across the lattice of its bytes: of
   its count, a discount d = n1 / (n1 + 2 n2) is left to the pieces.  So
   P(w) = (c - d)+ / N + d V / N * L(w), where L(w) is the marginal over pieces.
   The end of a document is a token of its own, of base probability ``END``.

``score`` is log10 of the product over a document's words and its end, the marginal
over all ways through its lattice; ``lattice_score`` takes pieces alone.  What is
gathered (words, counts, arcs) grows with the corpus and stays in Spark; only the
weights of the vocabulary's units and a handful of sums reach the driver.

Defined results: a null or empty text has the end alone; words are found in the
text with A-Z lowered; an id that is null counts as the text "null" when training
documents are picked; repeated rows are learnt and scored one by one; without
training documents N and V are 0 and ``score`` is the lattice alone; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careledger.llm import blocks as B
from careledger.llm.common import id_key, length_slices, stored

END = 1e-3              # base probability of the end
PRIOR = 1e4             # how many units the vocabulary's scores weigh
BATCH = 1 << 17         # bytes of words in one lattice
WORDS = 1 << 16         # words that are sorted by length at a time
SHORT = 128             # bytes of a word whose probability is tried as a plain number
LEAST = 1e-290          # and the least such number: what underflows on the way to it is 1e-18 of it
STRETCH = 1 << 16       # bytes of a long word that are looked at together
TEXT_STRETCH = 1 << 20
LOG10 = float(np.log(10))


def vocabulary_units(path: str) -> tuple[list[bytes], np.ndarray]:
    """(bytes, prior probability) of every unit that can stand in a word: a piece's bytes, U+2581 as a blank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scores = np.array([model.get_score(i) for i in ids])
    is_byte = np.array([model.is_byte(i) for i in ids])
    ranked = bool((scores == np.round(scores)).all())
    # Byte pieces carry no score: they weigh as the least of the others.
    least = scores[~is_byte & (scores > -1e8)].min() if (~is_byte).any() else 0.0
    scores = np.where(is_byte, least, scores)
    weights = 1 / (10 - np.minimum(scores, 0)) if ranked else np.exp(scores)
    units: dict[bytes, float] = {}
    for i, byte, w in zip(ids, is_byte.tolist(), weights.tolist(), strict=True):
        piece = model.id_to_piece(i)
        unit = bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode("utf-8")
        if unit and not set(unit[1:]) & set(b" \t\n\x0b\x0c\r") and unit[:1] not in b"\t\n\x0b\x0c\r":
            units[unit] = units.get(unit, 0.0) + w
    if set(range(256)) - {9, 10, 11, 12, 13} - {u[0] for u in units if len(u) == 1}:
        raise ValueError("the vocabulary has no piece for some byte")
    total = sum(units.values())
    return list(units), np.array([w / total for w in units.values()])


class Trie:
    """Units by their bytes: a table of children for nodes that have any."""

    def __init__(self, units: list[bytes]):
        nodes: dict[bytes, int] = {b"": 0}
        for unit in units:
            for n in range(1, len(unit) + 1):
                nodes.setdefault(unit[:n], len(nodes))
        inner = {p[:-1] for p in nodes if p}
        rows = {p: i + 1 for i, p in enumerate(sorted(inner))}      # row 0: no children
        self.children = np.zeros((len(rows) + 1, 256), np.int32)
        for prefix, node in nodes.items():
            if prefix:
                self.children[rows[prefix[:-1]], prefix[-1]] = node
        self.row = np.zeros(len(nodes), np.int32)
        for prefix in inner:
            self.row[nodes[prefix]] = rows[prefix]
        self.unit = np.full(len(nodes), -1, np.int32)
        for k, unit in enumerate(units):
            self.unit[nodes[unit]] = k
        self.longest = max(map(len, units))

    def arcs(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, unit) of every unit that begins at one of ``starts`` in the bytes ``x``."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        node, n = np.zeros(len(starts), np.int32), 0
        while len(starts):
            inside = starts + n < len(x)
            starts, node = (starts, node) if inside.all() else (starts[inside], node[inside])
            node = self.children[self.row[node], x[starts + n]]
            alive = node > 0
            starts, node, n = starts[alive], node[alive], n + 1
            ends = self.unit[node] >= 0
            out.append((starts[ends], starts[ends] + n, self.unit[node[ends]]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else \
            (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32))


@functools.lru_cache(2)
def trie(units: tuple[bytes, ...]) -> Trie:
    return Trie(list(units))


def _summed(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log of the sum of exp over the runs of ``values`` that begin at ``first``."""
    top = np.maximum.reduceat(values, first)
    size = np.diff(np.append(first, len(values)))
    return top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, size)), first))


def _steps(order_by: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Arcs by step, then by position, and where each step begins."""
    order = np.lexsort((at, order_by))
    return order, np.append(np.flatnonzero(np.diff(order_by[order], prepend=-1)), len(order))


class Lattice:
    """The units' log-probabilities over the lattices of many words at once."""

    def __init__(self, units: tuple[bytes, ...], probabilities: np.ndarray, stop: float):
        self.trie, self.logs, self.stop = trie(units), np.log(probabilities), float(np.log(stop))
        self.by_node = np.where(self.trie.unit >= 0, probabilities[self.trie.unit], 0.0)

    def _forward(self, alpha: np.ndarray, depth: np.ndarray, arcs: tuple[np.ndarray, ...]) -> None:
        """Fill ``alpha``: at a position, the log of the sum over all ways from the word's first byte to it."""
        start, end, unit = arcs
        order, steps = _steps(depth[end], end)
        start, end, weight = start[order], end[order], self.logs[unit[order]]
        for a, b in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
            e = end[a:b]
            first = np.flatnonzero(np.diff(e, prepend=-1))
            alpha[e[first]] = _summed(alpha[start[a:b]] + weight[a:b], first)

    def _laid_out(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Words, each behind a blank and before a line feed: bytes, where words begin and end, depth of each byte."""
        x = np.frombuffer(b"".join(b" " + w + b"\n" for w in words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        ends = np.cumsum(sizes) - 1
        first = ends - sizes + 1
        return x, first, ends, np.arange(len(x)) - np.repeat(first, sizes)

    def _ways(self, x: np.ndarray, sizes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list[tuple]]:
        """(probability of all ways to each position, arcs as (start, end, words, nodes)) for words that are columns
        of ``x``, the longest first.  What ends a column has no child in the trie."""
        children, row, flat = self.trie.children.reshape(-1), self.trie.row, x.reshape(-1)
        alpha = np.zeros((len(x) + 1, x.shape[1]))
        alpha[0] = 1
        arcs: list[tuple] = []
        for i in range(len(x)):
            word = np.arange(np.searchsorted(-sizes, -i))               # those with a byte at i
            node, before = np.zeros(len(word), np.int32), alpha[i, :len(word)]
            for j in range(i, len(x)):
                node = children[(row[node].astype(np.int64) << 8) + flat[word + j * x.shape[1]]]
                alive = np.flatnonzero(node)
                if not len(alive):
                    break
                if len(alive) < len(word):
                    word, node, before = word[alive], node[alive], before[alive]
                alpha[j + 1, word] += before * self.by_node[node]
                if keep:
                    arcs.append((i, j + 1, word, node))
        return alpha, arcs

    def _columns(self, words: pa.Array, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places, matrix of bytes, sizes) of words up to ``most`` bytes behind a blank, ``BATCH`` bytes at a time."""
        if not len(words):
            return
        _, offsets, data = words.cast(pa.binary()).buffers()
        starts = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
        data, sizes = np.frombuffer(data or b"", np.uint8), np.diff(starts)
        order = np.argsort(-sizes, kind="stable")
        at = int(np.searchsorted(-sizes[order], -most))
        while at < len(order):
            height = int(sizes[order[at]]) + 1
            part = order[at:at + max(BATCH // height, 1)]
            x, size = np.full((height, len(part)), 10, np.uint8), sizes[part]
            x[0] = 32
            for i in range(1, height):
                n = np.searchsorted(-size, -i, "right")
                x[i, :n] = data[starts[part[:n]] + i - 1]
            yield part, x, size + 1
            at += len(part)

    def marginals(self, words: list[bytes] | pa.Array) -> np.ndarray:
        """log of the probability of each word, over all its segmentations."""
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
        out = np.zeros(len(words))
        for part, x, sizes in self._columns(words, min(SHORT, STRETCH)):
            out[part] = self._ways(x, sizes)[0][sizes, np.arange(len(part))]
        rest = np.flatnonzero(out < LEAST)
        out[rest] = 1
        out = np.log(out)
        out[rest] = self._marginals(words.take(pa.array(rest)).to_pylist())
        return out + self.stop

    def _marginals(self, words: list[bytes]) -> np.ndarray:
        """The same in logs and without the stop, for words whose probability no plain number holds."""
        out = np.empty(len(words))
        for part in _parts(words):
            if len(part) == 1 and len(words[part[0]]) > STRETCH:
                out[part[0]] = self._long(b" " + words[part[0]])
                continue
            x, first, ends, depth = self._laid_out([words[k] for k in part])
            alpha = np.full(len(x), -np.inf)
            alpha[first] = 0
            self._forward(alpha, depth, self.trie.arcs(x, np.flatnonzero(x != 10)))
            out[part] = alpha[ends]
        return out

    def _long(self, word: bytes) -> float:
        """The same for a word of any length: stretch by stretch, with what reaches into the next."""
        whole, reach, known = np.frombuffer(word, np.uint8), self.trie.longest, np.zeros(1)
        for a in range(0, len(whole), STRETCH):
            b, back = min(a + STRETCH, len(whole)), len(known) - 1
            x = whole[a - back:b]
            alpha = np.full(len(x) + 1, -np.inf)
            alpha[:back + 1] = known
            start, end, unit = self.trie.arcs(x, np.arange(len(x)))
            new = end > back
            self._forward(alpha, np.arange(len(x) + 1), (start[new], end[new], unit[new]))
            known = alpha[-min(reach, len(alpha)):]
        return float(known[-1])

    def expected(self, words: list[bytes] | pa.Array) -> np.ndarray:
        """Expected count of each unit over all segmentations of the words.  Words over ``STRETCH`` bytes are
        counted by stretches."""
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
        done, by_node = np.zeros(len(words), bool), np.zeros(len(self.by_node))
        for part, x, sizes in self._columns(words, min(SHORT, STRETCH)):
            alpha, arcs = self._ways(x, sizes, keep=True)
            total = alpha[sizes, np.arange(len(part))]
            done[part] = total >= LEAST
            beta = np.zeros_like(alpha)             # already by the whole; 0 for words that are left to logs
            beta[sizes, np.arange(len(part))] = np.divide(1, total, out=np.zeros(len(part)), where=done[part])
            shares = []
            for i, j, word, node in reversed(arcs):
                after = self.by_node[node] * beta[j, word]
                beta[i, word] += after
                shares.append(after * alpha[i, word])
            if arcs:
                by_node += np.bincount(np.concatenate([a[3] for a in reversed(arcs)]), np.concatenate(shares), len(by_node))
        ends = self.trie.unit >= 0
        out = np.bincount(self.trie.unit[ends], by_node[ends], len(self.logs))
        return out + self._expected(words.filter(pa.array(~done)).to_pylist())

    def _expected(self, words: list[bytes]) -> np.ndarray:
        """The same in logs."""
        out = np.zeros(len(self.logs))
        cut = [w[a:a + STRETCH] for w in words for a in range(0, max(len(w), 1), STRETCH)]
        for part in _parts(cut):
            x, first, ends, depth = self._laid_out([cut[k] for k in part])
            arcs = self.trie.arcs(x, np.flatnonzero(x != 10))
            alpha, beta = np.full(len(x), -np.inf), np.full(len(x), -np.inf)
            alpha[first], beta[ends] = 0, 0
            self._forward(alpha, depth, arcs)
            start, end, unit = arcs
            height = np.repeat(depth[ends], ends - first + 1) - depth           # bytes that are left
            order, steps = _steps(height[start], start)
            s, e, weight = start[order], end[order], self.logs[unit[order]]
            for a, b in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
                run = np.flatnonzero(np.diff(s[a:b], prepend=-1))
                beta[s[a:b][run]] = _summed(beta[e[a:b]] + weight[a:b], run)
            total = np.repeat(alpha[ends], ends - first + 1)
            out += np.bincount(unit, np.exp(alpha[start] + self.logs[unit] + beta[end] - total[start]), len(out))
        return out


def _parts(words: list[bytes]) -> Iterator[list[int]]:
    """Numbers of words of similar length, ``BATCH`` bytes at a time; longer ones by themselves."""
    part, size = [], 0
    for k in sorted(range(len(words)), key=lambda k: len(words[k])):
        if part and size + len(words[k]) > BATCH:
            yield part
            part, size = [], 0
        part.append(k)
        size += len(words[k]) + 2
    if part:
        yield part


def _grouped(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches whose first column holds words, joined to ``WORDS`` rows or ``most`` bytes."""
    some, rows, size = [], 0, 0
    for batch in batches:
        some.append(batch)
        rows, size = rows + len(batch), size + batch.nbytes
        if rows >= WORDS or size >= most:
            yield pa.concat_batches(some)
            some, rows, size = [], 0, 0
    if rows:
        yield pa.concat_batches(some)


def stretches(text: str) -> Iterator[str]:
    """A long text, cut at blanks of the contract."""
    raw, at = text.encode("utf-8"), 0
    while at < len(raw):
        end = at + TEXT_STRETCH
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield raw[at:end].decode("utf-8")
        at = end


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts one after the other, A-Z lowered, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))     # at blanks of the contract
    words = lists.flatten()
    real = np.asarray(pc.binary_length(words)) > 0                                 # blanks at an end leave an empty one
    ends = np.concatenate([[0], np.cumsum(real)])[np.asarray(lists.offsets)]
    return words.filter(pa.array(real)), np.diff(ends)


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """(id, text, held) to blocks: words with their count in training documents, documents by places."""
    numbers, block, parts, sizes, held = B.block_numbers(), B.Block(), [], [], []

    def flush() -> Iterator[pa.RecordBatch]:
        coded = pa.concat_arrays(parts).dictionary_encode()
        flat, places = np.asarray(coded.indices), coded.dictionary
        size, out = np.concatenate(sizes), np.concatenate(held)
        train = np.bincount(flat[np.repeat(~out, size)], minlength=len(places))
        pairs = np.sort(np.repeat(np.arange(len(size)), size) << 32 | flat)
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        docs = pairs[first] >> 32
        blob = B.pack(pa.concat_arrays(block.ids), out, size, np.bincount(docs, minlength=len(size)).astype(np.int32),
                      (pairs[first] & 0xFFFFFFFF).astype(np.int32),
                      np.diff(np.append(first, len(pairs))).astype(np.int32))
        yield from B.entry_batches(next(numbers), places.cast(pa.binary()), train, int((~out).sum()), blob)

    for batch in batches:
        for start, end in length_slices(batch.column(1), min(TEXT_STRETCH, block_bytes)):
            rows = batch.slice(start, end - start)
            size = (pc.sum(pc.binary_length(rows.column(1))).as_py() or 0) + 64 * len(rows)
            if block.docs and block.bytes + size > block_bytes:
                yield from flush()
                block, parts, sizes, held = B.Block(), [], [], []
            if len(rows) == 1 and size > TEXT_STRETCH:
                words, counts = words_of(pa.array(stretches(rows.column(1)[0].as_py()), rows.column(1).type))
                counts = counts.sum(keepdims=True)
            else:
                words, counts = words_of(rows.column(1))
            parts.append(words)
            sizes.append(counts)
            held.append(rows.column(2).to_numpy(zero_copy_only=False))
            block.add(rows.column(0), size)
    if block.docs:
        yield from flush()


def _unit_weights(counts: DataFrame, units: tuple[bytes, ...], prior: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """(probability of each unit, probability that a word stops after one), from every different training word.

    One row a unit reaches the driver: a table as long as the vocabulary."""
    stop, now = 0.25, prior * 0.75
    words = counts.where("c > 0").select("key")
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], now=now, stop=stop) -> Iterator[pa.RecordBatch]:
            lattice, total, n = Lattice(units, now, stop), np.zeros(len(units)), 0
            for batch in _grouped(batches):
                total += lattice.expected(batch.column(0))
                n += len(batch)
            some = np.flatnonzero(total)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))],
                                                 names=["unit", "n"])

        rows = words.mapInArrow(expect, "unit long, n double").groupBy("unit").agg(F.sum("n").alias("n")).collect()
        found = {r["unit"]: r["n"] for r in rows}
        if not found:
            break
        n_words = found.pop(-1)
        count = PRIOR * prior
        for unit, n in found.items():
            count[unit] += n
        stop = (n_words + 0.25 * PRIOR) / (count.sum() + n_words + 0.25 * PRIOR)
        now = count / count.sum() * (1 - stop)
    return now, float(stop)


def score_documents(docs: DataFrame, path: str, held_out: int = 0, folds: int = 10, rounds: int = 2,
                    block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, lattice_score.  Documents with crc32(doc_id as text) mod ``folds`` = ``held_out`` are not learnt from."""
    fold = F.pmod(F.crc32(id_key("doc_id").cast("binary")), F.lit(folds))
    rows = docs.select(F.col("doc_id").alias("id"), "text", (fold == held_out).alias("held"))
    blocks = stored(rows.mapInArrow(functools.partial(_blocks, block_bytes=block_bytes), B.block_schema(T.BinaryType())),
                    "lm-blocks")
    counts = stored(B.entries(blocks).groupBy("key").agg(F.sum("n").alias("c")), "lm-counts")
    sums = counts.agg(F.sum("c").alias("n"), *(F.count_if(F.expr(e)).alias(a) for e, a in
                                               (("c > 0", "v"), ("c = 1", "n1"), ("c = 2", "n2")))).first()
    ends = blocks.where("key IS NULL").agg(F.sum("n")).first()[0] or 0
    total, types = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    discount = min(max(sums["n1"] / (sums["n1"] + 2 * sums["n2"]), 0.1), 0.9) if sums["n1"] else 0.5
    units, prior = vocabulary_units(path)
    units = tuple(units)
    weights, stop = _unit_weights(counts, units, prior, rounds)
    share = discount * types / total if total else 1.0

    def word_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(units, weights, stop)
        for batch in _grouped(batches):
            spelt = lattice.marginals(batch.column(0)) + np.log(1 - END)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spelt)], names=["key", "c", "spelt"])

    table = counts.mapInArrow(word_scores, "key binary, c long, spelt double")
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
        *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
        *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score", "lattice_score"))])
    floor = np.log10(total + 0.1 * (types + 1))
    end_score = float(np.log10(max(ends - discount, 0) / max(total, 1) + share * END))

    def finish(values: list[np.ndarray], ids: pa.Array, blob: tuple[np.ndarray, ...]) -> dict[str, pa.Array]:
        (c, spelt), (held, size, different, places, times) = values, blob
        with np.errstate(divide="ignore"):
            score = np.logaddexp(np.log(np.maximum(c - discount, 0) / max(total, 1)), np.log(share) + spelt)
        owner = np.repeat(np.arange(len(size)), different)
        add = lambda x: np.bincount(owner, x[places] * times, len(size))
        return {"doc_id": ids, "held_out": pa.array(held), "n_tokens": pa.array(size + 1),
                "n_known": pa.array(add((c > 0).astype(float)).astype(np.int64) + int(ends > 0)),
                "train_tokens": pa.array(np.full(len(size), total, np.int64)),
                "base_score": pa.array(add(np.log10(c + 0.1) - floor) + (np.log10(ends + 0.1) - floor)),
                "score": pa.array(add(score / LOG10) + end_score),
                "lattice_score": pa.array(add(spelt / LOG10) + np.log10(END))}

    return B.answer(blocks, table, ["c", "spelt"], finish, schema)
