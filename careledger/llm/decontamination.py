"""Operator 7, benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Every run of ``n`` words of a test item is a seed; how many documents hold each is
   counted over all documents.  The rarer half of an item's seeds, those of each
   stretch of it apart, are its rare seeds.
2. Seeds join the documents' runs of words.  Hits of one item whose diagonals lie
   together make a passage: the document words that the item could span around
   them, cut out of the whole text.
3. A passage that a rare seed points at is aligned.  One that only common seeds
   point at (any text has some "as well as") is aligned if it holds enough of the
   item's words to reach ``least``: an alignment of similarity s matches at least
   s of the item's words, so nothing is lost by leaving out the others.
4. A Smith-Waterman local alignment over words (match 2, mismatch -1, gap -1)
   scores each passage against its item, many passages at a time; the share of the
   item's perfect score is the similarity, so edits, dropped and inserted words
   cost little and paraphrased or edited copies are found.  A task passes on the
   pairs that reach ``least``, and of other rows the best one.

The benchmark is the bounded side: its seeds are joined where the documents are, in
blocks of at most ``SEED_BLOCK`` hashes, and a larger benchmark takes several passes.

Defined results: words are compared without case and punctuation.  A null or
empty text has no match (similarity 0); items of fewer than ``n`` words are one
seed, null or empty items none; a copy that shares no run of ``n`` words with its
item has no seed and is not aligned.  A row without a copy has the similarity of its
best aligned passage, 0 without any.  Of equal similarities the smallest item_id is
reported.  Repeated rows are judged one by one; empty tables give an empty
result or no match; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import (columns_of, id_key, length_slices, mixed, ngram_hashes, plain_bytes,
                                   spare_names, word_hashes)

SEED_BLOCK = 2_000_000
MOST_HITS = 1 << 20         # hits that are put together at a time (those of one text at least)
CELLS = 1 << 15             # cells in a row of the tables that are aligned at a time
MATCH, MISMATCH, GAP = 2, -1, -1


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    """Word hashes of each text, without case and punctuation; words of punctuation alone vanish."""
    words, counts, _ = word_hashes([plain_bytes(t) for t in texts])
    return np.split(words, np.cumsum(counts)[:-1]) if len(texts) else []


def _seeds(words: np.ndarray, n: int) -> np.ndarray:
    return ngram_hashes(words, min(n, len(words))) if len(words) else np.empty(0, np.uint64)


def item_seeds(benchmark: DataFrame, n: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(item_id, word hashes, seed hashes) of the benchmark, the bounded side."""
    rows = benchmark.where(F.col("item_id").isNotNull()).select("item_id", "text").toLocalIterator()
    found = ((r.item_id, words_of([r.text])[0]) for r in rows)
    return [(i, w, _seeds(w, n)) for i, w in found if len(w)]


def _maybe(seeds: np.ndarray) -> np.ndarray:
    """A bitmap that answers for most n-grams that they are no seed."""
    out = np.zeros(1 << 22, bool)
    out[(seeds & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
    return out


def _hits(texts: list[np.ndarray], seeds: np.ndarray, maybe: np.ndarray, widths: list[int]) -> tuple:
    """(index of the seed, position in all words of the texts, end of each text) of every seed that occurs."""
    words = np.concatenate(texts)
    ends = np.cumsum([len(t) for t in texts])
    which, where = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in widths:
        grams = ngram_hashes(words, n)
        look = np.flatnonzero(maybe[(grams & np.uint64((1 << 22) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(seeds, grams[look]), len(seeds) - 1)
        hit = seeds[at] == grams[look]
        at, look = at[hit], look[hit]
        inside = look + n <= ends[np.searchsorted(ends, look, side="right")]
        which.append(at[inside])
        where.append(look[inside])
    return np.concatenate(which), np.concatenate(where), ends


def align(a: np.ndarray, b: np.ndarray) -> int:
    """Score of the best local alignment of two word sequences (rows of the table as numpy arrays)."""
    if not len(a) or not len(b):
        return 0
    steps = np.arange(1, len(b) + 1)
    row, best = np.zeros(len(b) + 1, np.int64), 0
    for word in a:
        now = np.maximum(row[:-1] + np.where(b == word, MATCH, MISMATCH), row[1:] + GAP)
        now = np.maximum(now, 0)
        # A gap along the row: the best of all cells to the left, each less its distance.
        now = np.maximum.accumulate(now - GAP * steps) + GAP * steps
        best = max(best, int(now.max()))
        row[1:] = now
    return best


def align_many(text: np.ndarray, low: np.ndarray, high: np.ndarray, pool: np.ndarray, begin: np.ndarray,
               length: np.ndarray) -> np.ndarray:
    """``align`` of every passage ``text[low:high]`` with its item ``pool[begin:begin + length]``, in blocks of like sizes."""
    out, width = np.zeros(len(low), np.int64), high - low
    order = np.lexsort((width, length))
    done = 0
    while done < len(order):
        # As many tables as fit beside each other; their widest row is not known before, so it is looked for by halves.
        many = min(len(order) - done, CELLS)
        while many > 1 and many * (int(width[order[done:done + many]].max()) + 1) > CELLS:
            many = (many + 1) // 2
        k = order[done:done + many]
        done += many
        columns = np.arange(int(width[k].max()))
        inside = columns < width[k, None]
        words = text[np.minimum(low[k, None] + columns, len(text) - 1)]
        steps = -GAP * (columns + 1).astype(np.int32)
        row, best = np.zeros((len(k), len(columns) + 1), np.int32), np.zeros(len(k), np.int32)
        for i in range(int(length[k].max())):
            word = pool[begin[k] + np.minimum(i, length[k] - 1)]
            same = (words == word[:, None]) & inside & (i < length[k])[:, None]
            now = np.maximum(row[:, :-1] + np.where(same, np.int32(MATCH), np.int32(MISMATCH)), row[:, 1:] + np.int32(GAP))
            now = np.maximum(now, 0)
            now = np.maximum.accumulate(now + steps, axis=1) - steps
            best = np.maximum(best, now.max(1))
            row[:, 1:] = now
        out[k] = best
    return out


STRETCHES = 3               # of an item, each with rare seeds of its own


class _Items:
    """Items of a block of the benchmark: their words, and which seeds stand where in which item."""

    def __init__(self, block: list[tuple[int, np.ndarray, np.ndarray]]):
        self.ids = np.array([i for i, _, _ in block], np.int64)
        self.length = np.array([len(w) for _, w, _ in block], np.int64)
        self.pool = np.concatenate([w for _, w, _ in block])
        self.begin = np.cumsum(self.length) - self.length
        self.slack = self.length // 2 + 4
        many = [len(s) for _, _, s in block]
        self.seeds, seed = np.unique(np.concatenate([s for _, _, s in block]), return_inverse=True)
        order = np.argsort(seed, kind="stable")
        self.item = np.repeat(np.arange(len(block)), many)[order]
        self.place = np.concatenate([np.arange(m) for m in many])[order]
        self.owners = np.bincount(seed, minlength=len(self.seeds))
        self.first = np.cumsum(self.owners) - self.owners
        self.many = np.array(many, np.int64)
        self.rare = np.ones(len(self.item), bool)
        self.seed = np.repeat(np.arange(len(self.seeds)), self.owners)

    def know(self, documents: np.ndarray) -> None:
        """Mark the rare seeds by the number of documents that hold each."""
        stretch = self.item * STRETCHES + np.minimum(self.place * STRETCHES // np.maximum(self.many[self.item], 1), STRETCHES - 1)
        order = np.lexsort((self.place, documents[self.seed], stretch))
        size = np.bincount(stretch, minlength=len(self.ids) * STRETCHES)
        rank = np.arange(len(order)) - np.repeat(np.cumsum(size) - size, size)
        self.rare[order] = rank < -(-np.repeat(size, size) // 2)

    def reachable(self, words: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray, least: float) -> np.ndarray:
        """Whether each passage ``words[low:high]`` holds enough of its item's words for a similarity of ``least``."""
        out, width, done = np.zeros(len(item), bool), high - low, 0
        load = np.concatenate([[0], np.cumsum(self.length[item] + width)])
        while done < len(item):
            stop = max(int(np.searchsorted(load, load[done] + MOST_HITS, side="right")) - 1, done + 1)
            i, n, span = item[done:stop], self.length[item[done:stop]], width[done:stop]
            pair = mixed(np.arange(1, len(i) + 1, dtype=np.uint64))
            own = np.repeat(pair, n) ^ self.pool[np.repeat(self.begin[i] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            there = np.repeat(pair, span) ^ words[np.repeat(low[done:stop] - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))]
            held = np.bincount(np.repeat(np.arange(len(i)), n), np.isin(own, there), len(i))
            out[done:stop] = held >= least * n - 1e-9
            done = stop
        return out

    def passages(self, which: np.ndarray, where: np.ndarray, row: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple:
        """(row, item, low, high, by a rare seed) of the passages that hits point at, by row and item."""
        many = self.owners[which]
        hit = np.repeat(np.arange(len(which)), many)
        at = np.repeat(self.first[which] - (np.cumsum(many) - many), many) + np.arange(len(hit))
        row, item, start, rare = row[hit], self.item[at], where[hit] - self.place[at], self.rare[at]
        order = np.lexsort((start, item, row))
        row, item, start, rare = row[order], item[order], start[order], rare[order]
        apart = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > self.slack[item[1:]])
        first = np.flatnonzero(np.concatenate([[True], apart]))
        last = np.append(first[1:], len(row)) - 1
        rare = np.logical_or.reduceat(rare, first)
        row, item, low, high = row[first], item[first], start[first], start[last]
        low = np.maximum(begins[row], low - self.slack[item])
        return row, item, low, np.minimum(ends[row], high + self.length[item] + self.slack[item]), rare


def _seed_documents(docs: DataFrame, items: _Items, widths: list[int]) -> np.ndarray:
    """In how many rows each seed occurs: one number a seed of the block, counted over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe, total = _maybe(items.seeds), np.zeros(len(items.seeds), np.int64)
        for batch in batches:
            for a, b in length_slices(batch.column(0)):
                texts = words_of(batch.column(0).slice(a, b - a).to_pylist())
                which, where, ends = _hits(texts, items.seeds, maybe, widths)
                row = np.searchsorted(ends, where, side="right")
                total += np.bincount(np.unique(row * len(total) + which) % len(total), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["seed", "n"])

    out = np.zeros(len(items.seeds), np.int64)
    for r in docs.select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect():
        out[r.seed] = r.n
    return out


def _similar(docs: DataFrame, items: _Items, widths: list[int], keep: list[str], least: float) -> DataFrame:
    """(keep..., item_id, similarity): each row with the items that it may hold, or with the one most like it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _maybe(items.seeds)
        for batch in batches:
            for a, b in length_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                texts = words_of(part.column(0).to_pylist())
                words = np.concatenate(texts)
                which, where, ends = _hits(texts, items.seeds, maybe, widths)
                begins = ends - [len(t) for t in texts]
                order = np.argsort(where, kind="stable")
                which, where = which[order], where[order]
                row = np.searchsorted(ends, where, side="right")
                # Hits of whole texts, MOST_HITS (item, place) pairs at a time.
                load = np.concatenate([[0], np.cumsum(items.owners[which])])
                done = 0
                while done < len(which):
                    stop = int(np.searchsorted(load, load[done] + MOST_HITS, side="right")) - 1
                    if stop < len(which):
                        stop = int(np.searchsorted(row, row[stop]))
                    if stop <= done:
                        stop = int(np.searchsorted(row, row[done], side="right"))
                    some = slice(done, stop)
                    done = stop
                    at, item, low, high, rare = items.passages(which[some], where[some], row[some], begins, ends)
                    rare[~rare] = items.reachable(words, item[~rare], low[~rare], high[~rare], least)
                    at, item, low, high = at[rare], item[rare], low[rare], high[rare]
                    if not len(at):
                        continue
                    score = align_many(words, low, high, items.pool, items.begin[item], items.length[item])
                    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (item[1:] != item[:-1])]))
                    at, item = at[first], item[first]
                    best = np.maximum.reduceat(score, first) / (MATCH * items.length[item])
                    # The pairs that reach ``least``, and the first of a row's best ones.
                    order = np.lexsort((items.ids[item], -best, at))
                    stays = np.concatenate([[True], at[order][1:] != at[order][:-1]]) | (best[order] >= least)
                    at, item, best = at[order][stays], item[order][stays], best[order][stays]
                    took = part.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*took.columns[1:], pa.array(items.ids[item]), pa.array(best)],
                                                     names=[*keep, "item_id", "similarity"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select("text", *keep).mapInArrow(run, kinds + "item_id long, similarity double")


def matches(docs: DataFrame, benchmark: DataFrame, n: int = 3, least: float = 0.6,
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep..., item_id, similarity) of every row and item with a similarity of ``least`` that share a seed; rows
    without such an item come with the aligned one that is most like them (in each block of the benchmark)."""
    keep = list(keep)
    items = item_seeds(benchmark, n)
    widths = sorted({min(n, len(w)) for _, w, _ in items})
    out = None
    block, seeds = [], 0
    for k, item in enumerate(items):
        block.append(item)
        seeds += len(item[2])
        if k + 1 < len(items) and seeds < SEED_BLOCK:
            continue
        known = _Items(block)
        known.know(_seed_documents(docs, known, widths))
        part = _similar(docs, known, widths, keep, least)
        out = part if out is None else out.unionByName(part)
        block, seeds = [], 0
    if out is None:
        return docs.select(*keep, F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("similarity")).limit(0)
    return out


def _keyed(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with two keys, which rows share only where they have one verdict: same id, same text."""
    return docs.withColumns(dict(zip(names, (id_key("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256)), strict=True)))


def _verdicts(keyed: DataFrame, benchmark: DataFrame, least: float, **how) -> DataFrame:
    """(_key, _digest, similarity, item_id, n_items) of the rows that share a seed with an item."""
    return matches(keyed, benchmark, least=least, keep=("_key", "_digest"), **how).groupBy("_key", "_digest").agg(
        F.max("similarity").alias("similarity"),
        F.max_by("item_id", F.struct("similarity", -F.col("item_id"))).alias("item_id"),
        F.count_distinct(F.when(F.col("similarity") >= least, F.col("item_id"))).alias("n_items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, least: float = 0.6, **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, similarity, item_id, n_items."""
    keyed = _keyed(docs.select("doc_id", "text"), ["_key", "_digest"])
    rows = keyed.select("doc_id", "_key", "_digest").join(_verdicts(keyed, benchmark, least, **how), ["_key", "_digest"], "left")
    hit = F.coalesce(F.col("similarity") >= least, F.lit(False))
    return rows.select("doc_id", hit.alias("contaminated"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
                       F.when(hit, F.col("item_id")).alias("item_id"), F.coalesce("n_items", F.lit(0)).alias("n_items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.6, **how) -> DataFrame:
    """The documents without a benchmark passage, with their columns as they are."""
    names = ["_key", "_digest"]
    bad = _verdicts(_keyed(docs.select("doc_id", "text"), names), benchmark, least, **how).where(F.col("similarity") >= least)
    own = spare_names(docs, *names)
    bad = bad.select(*[F.col(n).alias(o) for n, o in zip(names, own, strict=True)])
    return _keyed(docs, own).join(bad, own, "left_anti").select(*columns_of(docs))
