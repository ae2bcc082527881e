"""Operator 6, toxicity by maximum-scoring segment search.

1. Words and word beginnings (stems of inflected words) of all documents are
   features, known by their 64-bit hash and counted by it over all rows and over
   labelled rows by class.
2. The log-odds ratio of the two classes is taken for each feature that labelled
   rows hold under an informative Dirichlet prior whose base measure is the whole
   corpus.  A word scores the ratio of its most certain feature (largest |z|), or
   zero where that could be chance (|z| below ``z_least``) or no labelled row holds
   any; a drift is taken off, so that ordinary text scores below zero on average.
   Only the features that are certain enough to count make up the model.
3. A linear-time scan finds every maximal scoring segment of a text.  Lambda of
   the extreme-value law of segment scores solves sum p(w) exp(lambda s(w)) = 1,
   K is fitted on the clean labelled rows, and a segment of score S in a text of
   n words has the E-value K n exp(-lambda S).  Segments with an E-value of at
   most ``e_most`` are the toxic passages.
4. A logistic calibration of the passages' evidence on labelled rows gives the
   score of a document.

Labelled rows are a documented bounded sample: at most ``MAX_LABELLED`` rows, the
smallest hashes of the ids; everything else covers all rows.

Defined results: a null or empty text has no passage and gets the calibrated
score of no evidence; ties in the scan extend a segment to the left end that
comes first; rows that repeat an id are scored one by one; labels of a repeated
id count as toxic if one is; an empty table gives an empty result; without
usable labels every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import length_slices, plain_bytes, stored, word_hashes

MAX_LABELLED = 200_000
STEMS = (4, 5, 6, 7, 8, 9)  # bytes of the word beginnings that count
HELD = 1 << 18              # different words that a task counts before it writes them
MAYBE_BITS = 20
TOTAL = 0                   # no feature: its row holds the sums over all features


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word and its beginnings (0 where a word has none), and how many words each text has.

    Words are taken without case and punctuation; words of punctuation alone vanish."""
    words, counts, stems = word_hashes([plain_bytes(t) for t in texts], STEMS)
    return np.column_stack([words, stems]), counts


def labelled(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(id, toxic) of the learnable labels, at most ``most`` rows."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    rows = labels.where(F.col("toxic").isNotNull() & (fold != 1)).groupBy(F.col("doc_id").alias("id")).agg(
        F.max("toxic").alias("toxic"))
    return rows.orderBy(F.xxhash64("id"), "id").limit(most)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different keys, a place of each, sums of their counts [key, 3])."""
    keys, first, which = np.unique(keys, return_index=True, return_inverse=True)
    return keys, first, np.column_stack([np.bincount(which, c, len(keys)) for c in counts.T]).astype(np.int64)


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, n_all, n_toxic, n_clean) of ``rows`` (text, toxic or null), and a row ``TOTAL`` of the sums."""
    names = ["feature", "n_all", "n_toxic", "n_clean"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []       # features of different words, how often those occur
        size = 0

        def write() -> pa.RecordBatch:
            hashes, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            _, first, counts = _summed(hashes[:, 0], counts)
            flat = hashes[first].ravel()
            there = flat != 0
            keys, _, sums = _summed(flat[there], np.repeat(counts, hashes.shape[1], axis=0)[there])
            sums = np.vstack([sums, sums.sum(0)])
            return pa.RecordBatch.from_arrays([pa.array(np.append(keys, np.uint64(TOTAL)).view(np.int64)),
                                               *(pa.array(c) for c in sums.T.copy())], names=names)

        for batch in batches:
            for a, b in length_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                hashes, sizes = features(part.column(0).to_pylist())
                label = np.repeat([-1 if x is None else int(x > 0) for x in part.column(1).to_pylist()], sizes)
                if not len(hashes):
                    continue
                _, first, counts = _summed(hashes[:, 0], np.column_stack([np.ones(len(label)), label == 1, label == 0]))
                held.append((hashes[first], counts))
                size += len(first)
                if size >= HELD:
                    yield write()
                    held, size = [], 0
        if held:
            yield write()

    parts = rows.select("text", "toxic").mapInArrow(run, "feature long, n_all long, n_toxic long, n_clean long")
    return parts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in names[1:]])


@dataclass
class Model:
    features: np.ndarray         # hashes of the features that are certain enough, in order
    ratios: np.ndarray           # their log-odds ratios
    certainty: np.ndarray        # their |z|
    drift: float = 0.7
    rate: float = 1.0            # lambda of the extreme-value law
    size: float = 0.1            # its K
    weights: tuple = (-20.0, 0.0, 0.0, 0.0)

    def __post_init__(self) -> None:
        """A bitmap answers for most features that they are not in the model."""
        self.maybe = np.zeros(1 << MAYBE_BITS, bool)
        self.maybe[self.features >> np.uint64(64 - MAYBE_BITS)] = True

    def word_scores(self, hashes: np.ndarray) -> np.ndarray:
        """The score of each word, by the most certain of its features."""
        z, ratio, flat = np.zeros(hashes.shape), np.zeros(hashes.shape), hashes.ravel()
        look = np.flatnonzero(self.maybe[flat >> np.uint64(64 - MAYBE_BITS)])
        at = np.minimum(np.searchsorted(self.features, flat[look]), len(self.features) - 1)
        hit = self.features[at] == flat[look]
        z.ravel()[look[hit]], ratio.ravel()[look[hit]] = self.certainty[at[hit]], self.ratios[at[hit]]
        return ratio[np.arange(len(z)), z.argmax(1)] - self.drift


def log_odds(counts: DataFrame, everything: int, toxic: int, clean: int, prior: float = 0.2) -> DataFrame:
    """``counts`` with ratio and z of each feature; ``prior``: pseudo-counts, as a share of the labelled ones."""
    strength = prior * (toxic + clean)
    alpha = F.col("n_all") * F.lit(strength / everything)

    def odds(n: str, total: int) -> Column:
        return F.log((F.col(n) + alpha) / (F.lit(total + strength) - F.col(n) - alpha))

    return counts.withColumn("ratio", odds("n_toxic", toxic) - odds("n_clean", clean)).withColumn(
        "z", F.col("ratio") / F.sqrt(1 / (F.col("n_toxic") + alpha) + 1 / (F.col("n_clean") + alpha)))


def decay_rate(scores: np.ndarray, weight: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1."""
    p = weight / weight.sum()
    if not (scores[p > 0] > 0).any() or (p * scores).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    with np.errstate(over="ignore"):
        while (p * np.exp(high * scores)).sum() < 1:
            high *= 2
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if (p * np.exp(mid * scores)).sum() < 1 else (low, mid)
    return high


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in one pass (Ruzzo and Tompa 1999)."""
    up = scores > 0
    if not up.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], up.view(np.int8), [0]])))
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[tuple[int, int, float, float, int]] = []      # start, end, sum before, sum up to the end, link
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        left, right = float(sums[start]), float(sums[end])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= right:
                kept.append((start, end, left, right, j))
                break
            start, left = kept[j][0], kept[j][2]
            del kept[j:]
    return [(s, e, r - x) for s, e, x, r, _ in kept]


def fit(docs: DataFrame, labels: DataFrame, z_least: float = 3.0) -> Model:
    """Learn word scores, extreme-value law and calibration (collects the features of labelled rows with a |z| of
    ``z_least`` at least, and ``MAX_LABELLED`` rows of three numbers)."""
    docs = docs.select("doc_id", "text")
    sample = F.broadcast(labelled(labels))                    # at most MAX_LABELLED rows of two numbers
    rows = docs.join(sample, docs.doc_id == sample.id, "left").select("text", "toxic")
    counts = stored(feature_counts(rows).where((F.col("n_toxic") + F.col("n_clean") > 0) | (F.col("feature") == TOTAL)),
                    "toxicity-features")
    none = Model(np.empty(0, np.uint64), np.empty(0), np.empty(0))
    total = counts.where(F.col("feature") == TOTAL).first()
    if total is None or not total.n_toxic or not total.n_clean:
        return none
    odds = log_odds(counts.where(F.col("feature") != TOTAL), total.n_all, total.n_toxic, total.n_clean)
    got = odds.where(F.abs("z") >= z_least).select("feature", "n_all", "ratio", F.abs("z").alias("z")).toPandas()
    hashes = got["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    ratios = got["ratio"].to_numpy(float)[order]
    model = Model(hashes[order], ratios, got["z"].to_numpy(float)[order])
    if not (ratios > model.drift).any():
        return model
    # All other features score alike.
    often = got["n_all"].to_numpy(float)[order]
    model.rate = decay_rate(np.append(ratios, 0.0) - model.drift, np.append(often, total.n_all - often.sum()))
    known = docs.join(sample, docs.doc_id == sample.id).select("text", "toxic")
    known = stored(_segments(known, model, ["toxic"]), "toxicity-labelled")
    scored = known.selectExpr("toxic", "n_words", "array_max(transform(passages, x -> x.score)) best").toPandas()
    clean = scored[(scored.toxic == 0) & (scored.n_words > 0)]
    tail = (clean.n_words * np.exp(-model.rate * clean.best.fillna(0.0))).sum()
    model.size = float(max(len(clean) / tail, 1e-6)) if tail else model.size
    sets = _with_evidence(known, model).select("toxic", *_feature_columns()).toPandas()
    model.weights = _logistic(np.log1p(sets[["a", "b", "c"]].to_numpy(float)), (sets.toxic > 0).to_numpy(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple:
    """Weights of a logistic regression with a small ridge, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


_PASSAGES = "n_words int, passages array<struct<start:int,end:int,score:double>>"


def _segments(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, number of words and all maximal segments (word offsets) of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in length_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                hashes, sizes = features(part.column(0).to_pylist())
                values, ends = model.word_scores(hashes), np.cumsum(sizes)
                found = [[{"start": s, "end": e, "score": x} for s, e, x in maximal_segments(values[j - n:j])]
                         for j, n in zip(ends.tolist(), sizes.tolist())]
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(sizes, pa.int32()), pa.array(found, kind)],
                    names=[*keep, "n_words", "passages"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(text_col, *keep).mapInArrow(run, kinds + _PASSAGES)


def _with_evidence(scored: DataFrame, model: Model, e_most: float = 1.0) -> DataFrame:
    """Passages with an E-value of at most ``e_most``, each with its evidence (minus log E)."""
    evidence = lambda x: F.lit(model.rate) * x.score - F.log(F.lit(model.size) * F.greatest("n_words", F.lit(1)))
    return scored.withColumn("passages", F.filter(F.transform("passages", lambda x: F.struct(
        x.start.alias("start"), x.end.alias("end"), x.score.alias("score"), evidence(x).alias("evidence"))),
        lambda x: x.evidence > -np.log(e_most)))


def _feature_columns(passages: str = "passages") -> list:
    values = F.transform(passages, lambda x: x.evidence)
    return [F.coalesce(F.array_max(values), F.lit(0.0)).alias("a"),
            F.aggregate(values, F.lit(0.0), lambda s, x: s + x).alias("b"), F.size(passages).cast("double").alias("c")]


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, passages, score) of every row; passages are word ranges with score and evidence."""
    rows = _with_evidence(_segments(docs, model, [id_col], text_col), model)
    w = model.weights
    a, b, c = _feature_columns()
    z = F.lit(w[0]) + F.lit(w[1]) * F.log1p(a) + F.lit(w[2]) * F.log1p(b) + F.lit(w[3]) * F.log1p(c)
    return rows.withColumn("score", 1 / (1 + F.exp(-z)))


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    docs = docs.select("doc_id", "text")
    scored = score_toxicity(docs, fit(docs, labels))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
