"""Operator 2, n-gram Jaccard join by T-occurrence search.

A document's set are its distinct shingles of ``width`` words.  Documents link
when the Jaccard similarity of their sets reaches ``least`` percent; a component
is what links reach.  Documents with equal sets are one class and take part as
its smallest id.

To link with a set of n shingles, a set must share at least T of them (T =
ceil(3n/4) at 75 percent).  Of its n inverted lists the T - 1 longest cannot
decide that alone, so two linked sets share a shingle among their n - T + 1
rarest ones.  Rarity needs the same order everywhere, not exact counts: shingles
that are frequent in a bounded sample of documents come last, by frequency, the
others by hash.  Only these short lists are built by shuffle; lists of one class
vanish in the task that holds them.

Candidates come from the short lists in two steps that never list all pairs of a
list.  First every class meets the one leader (smallest id of a list) that it
shares most lists with; near copies thereby become one component.  Then lists
that still hold several components pair their minority with the rest, across
components only.  Set sizes, list positions and a parity bitmap bound the
overlap from above and refute pairs without loss.

Candidates of a query meet its whole set in blocks of ``BLOCK`` documents, where
DivideSkip (Li, Lu and Lu 2008) finds those with the required overlap: a heap
merges the short inverted lists, the long ones are probed by binary search.

Defined results: words are runs other than blanks and \\t\\n\\v\\f\\r, ASCII letters
in lower case.  With fewer words than ``width`` the whole sequence is the one
shingle; a null text or one without words has an empty set, links with nothing
and is its own component.  Rows with words that repeat an id share its component.
A row without an id links with nothing and has no component.  An empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import (attach_group, columns_of, id_key, length_slices, ngram_hashes, salted_lookup,
                                   spare_names, stored, word_hashes)
from careledger.llm.components import components

BLOCK = 256                 # candidates that one query meets at a time
SAMPLE = 100_000            # documents that the rarity order samples at most
FREQUENT = 1 << 20          # frequent shingles that the order knows at most
LIST_ROWS = 1_000_000       # postings a task holds
SHORT_LIST = 256            # members of a list up to which its pairs are joined before bitmaps are looked at
LIST_BLOCK = 2_000          # members of a longer list that a block holds on either side
FEW_IDS = 500_000           # ids (8 bytes each) that are broadcast at most


def shingles(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    words, counts, _ = word_hashes([(t or "").encode("utf-8").lower() for t in texts])
    grams, out, at = ngram_hashes(words, width), [], 0
    for n in counts.tolist():
        own = grams[at:at + n - width + 1] if n >= width else ngram_hashes(words[at:at + n], n) if n else words[:0]
        out.append(np.unique(own))
        at += n
    return out


def required(n: int, m: int, least: int) -> int:
    """Least overlap of sets of n and m elements with 100 * overlap >= least * union."""
    return -(-least * (n + m) // (100 + least))


def frequent_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of at most about ``SAMPLE`` documents repeats, sorted, and how often it does
    (only an order: results do not depend on it)."""
    total = max(1, docs.count())
    one_in = max(16, -(-total // SAMPLE))
    sample = docs.where(F.pmod(F.xxhash64("id"), F.lit(one_in)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in length_slices(batch.column(0)):
                sets = shingles(batch.column(0).slice(a, b - a).to_pylist(), width)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["h"])

    often = (sample.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
             .where("n >= 2").orderBy(F.desc("n"), "h").limit(FREQUENT).toPandas())
    h, n = often["h"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def _parity(own: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set, two to four bits for each element; halves folded by XOR give the next smaller one."""
    bits = max(64, 1 << (2 * len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class _Rarity:
    """How often the sample repeats a shingle; a bitmap answers for most that it does not."""

    def __init__(self, known: np.ndarray, weight: np.ndarray):
        self.known, self.weight = known, weight
        self.maybe = np.zeros(1 << 24, bool)
        self.maybe[(known & np.uint64((1 << 24) - 1)).astype(np.int64)] = True

    def order(self, own: np.ndarray) -> tuple[np.ndarray, int]:
        """``own`` with its rarest shingles first, and how many of them the sample does not repeat."""
        look = np.flatnonzero(self.maybe[(own & np.uint64((1 << 24) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, own[look]), len(self.known) - 1)
        hit = self.known[at] == own[look]
        look, often = look[hit], self.weight[at[hit]]
        rare = np.delete(own, look)
        return np.concatenate([rare, own[look[np.argsort(often, kind="stable")]]]), len(rare)


def signatures(docs: DataFrame, width: int, least: int) -> DataFrame:
    """id, n, fp (fingerprint of the set), rare and frequent parts of the prefix in order, parity bitmap.

    The prefix and the bitmap are null for a set that the same task has already written."""
    known, weight = frequent_shingles(docs, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, seen = _Rarity(known, weight), set()
        for batch in batches:
            for a, b in length_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                out: dict[str, list] = {"n": [], "fp": [], "rare": [], "often": [], "bits": []}
                sets = shingles(part.column(0).to_pylist(), width)
                for own, doc in zip(sets, part.column(1).to_pylist(), strict=True):
                    n = len(own)
                    fp = xxhash.xxh3_128_digest(own.tobytes()) if n else None
                    rare = often = bits = None
                    if n and doc is not None and fp not in seen:
                        seen.add(fp)
                        first, cold = rarity.order(own) if len(known) else (own, n)
                        first = first[:n - -(-least * n // 100) + 1].view(np.int64)
                        rare, often, bits = first[:cold], first[cold:], _parity(own)
                    for name, value in (("n", n), ("fp", fp), ("rare", rare), ("often", often), ("bits", bits)):
                        out[name].append(value)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(out["n"], pa.int64()), pa.array(out["fp"], pa.binary()),
                     pa.array(out["rare"], longs), pa.array(out["often"], longs), pa.array(out["bits"], longs)],
                    names=["id", *out])

    return docs.select("text", "id").mapInArrow(
        run, "id long, n long, fp binary, rare array<bigint>, often array<bigint>, bits array<bigint>")


def shared_postings(postings: DataFrame, rows: int) -> DataFrame:
    """The (h, id, pos) of shingles that at least two rows hold; a task keeps about ``LIST_ROWS`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [tuple(c.to_numpy() for c in b.columns) for b in batches]
        if not parts:
            return
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        order = np.argsort(columns[0], kind="stable")
        h = columns[0][order]
        same = h[1:] == h[:-1]
        keep = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=["h", "id", "pos"])

    return (postings.select("h", "id", "pos").repartition(max(1, -(-rows // LIST_ROWS)), "h")
            .mapInArrow(run, "h long, id long, pos int"))


def divide_skip(query: np.ndarray, others: list[np.ndarray], least: int, skip_cost: float = 0.01) -> list[int]:
    """Numbers of the sorted sets of ``others`` that overlap ``query`` enough."""
    n = len(query)
    needed = [required(n, len(o), least) for o in others]
    tokens = np.concatenate(others)
    owner = np.repeat(np.arange(len(others)), [len(o) for o in others])
    at = np.minimum(np.searchsorted(query, tokens), n - 1)
    hit = query[at] == tokens
    at, owner = at[hit], owner[hit]
    order = np.argsort(at, kind="stable")                     # within a list the owners stay sorted
    at, owner = at[order], owner[order]
    ends = np.searchsorted(at, np.arange(n + 1))
    lists = [owner[a:b].tolist() for a, b in zip(ends, ends[1:]) if b > a]
    lists.sort(key=len)
    longest = len(lists[-1]) if lists else 0
    least_needed = min(needed)
    skipped = max(0, min(least_needed - 1, len(lists),
                         int(least_needed / (skip_cost * np.log2(max(longest, 2)) + 1))))
    short, long_ = lists[:len(lists) - skipped], lists[len(lists) - skipped:]
    found = []
    for k, run in groupby(heapq.merge(*short)):
        count = sum(1 for _ in run)
        if count < needed[k] - skipped:
            continue
        for left, probe in zip(range(len(long_), 0, -1), long_):
            if count + left < needed[k]:
                break
            i = bisect.bisect_left(probe, k)
            count += i < len(probe) and probe[i] == k
        if count >= needed[k]:
            found.append(k)
    return found


def _bound(a: str, b: str, least: int) -> Column:
    """Whether sizes, positions in a common short list and bitmaps allow an overlap that is large enough."""
    n, m, i, j = (F.col(x) for x in (f"{a}.n", f"{b}.n", f"{a}.pos", f"{b}.pos"))
    needed = F.ceil(least * (n + m) / F.lit(100.0 + least) - F.lit(1e-6))
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return (100 * n >= least * m) & (100 * m >= least * n) & (most >= needed)


def _bitmaps_allow(a: str, b: str, least: int) -> Column:
    """Sets differ in at least as many elements as their bitmaps: overlap <= (n + m - differing bits) / 2."""
    def folded(x: Column, y: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(y), F.zip_with(
            F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(x)

    x, y = F.col(f"{a}.bits"), F.col(f"{b}.bits")             # allowed sizes differ by less than two halvings
    differing = F.aggregate(F.zip_with(folded(x, y), folded(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                            F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0)))
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 + least) * (n + m - differing) >= 2 * least * (n + m)


def _allowed_in_block(x: dict, y: dict, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of x, row of y) of one list that sizes, positions, components and bitmaps allow."""
    found = [], []

    def words(rows: dict, own: np.ndarray, to: int) -> np.ndarray:
        """Bitmaps of the rows as a matrix, folded to ``to`` words."""
        out = np.array([rows["bits"][k] for k in own.tolist()])
        while out.shape[1] > to:
            out = out[:, :out.shape[1] // 2] ^ out[:, out.shape[1] // 2:]
        return out

    widths = [np.array([len(b) for b in side["bits"]]) for side in (x, y)]
    for wx in np.unique(widths[0]):
        for wy in np.unique(widths[1]):
            to = min(wx, wy)
            if max(wx, wy) > 2 * to:                          # sizes that differ so much cannot link
                continue
            mine, theirs = np.flatnonzero(widths[0] == wx), np.flatnonzero(widths[1] == wy)
            b = words(y, theirs, to)
            m, j = y["n"][theirs], y["pos"][theirs]
            for a in range(0, len(mine), 64):
                own = mine[a:a + 64]
                n, i = x["n"][own][:, None], x["pos"][own][:, None]
                apart = np.zeros((len(own), len(theirs)), np.int64)
                mat = words(x, own, to)
                for k in range(to):
                    apart += np.bitwise_count(mat[:, k][:, None] ^ b[:, k][None, :])
                most = np.minimum(np.minimum(i, j) + 1 + np.minimum(n - i - 1, m - j - 1), (n + m - apart) // 2)
                ok = ((100 + least) * most >= least * (n + m)) & (100 * n >= least * m) & (100 * m >= least * n)
                ok &= x["root"][own][:, None] != y["root"][theirs]
                ok &= ~y["minor"][theirs] | (x["id"][own][:, None] < y["id"][theirs])
                r, c = np.nonzero(ok)
                found[0].append(own[r])
                found[1].append(theirs[c])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *found[0]]), np.concatenate([none, *found[1]])


def crossed_in_blocks(lists: DataFrame, least: int) -> DataFrame:
    """Candidate pairs (q, d) of long lists, the minority against all members, in blocks of ``LIST_BLOCK``
    by ``LIST_BLOCK`` rows; only pairs that the bitmaps allow leave a block."""
    spread = lambda n: F.ceil(F.col(n) / LIST_BLOCK).cast("int")
    spot = lambda n: F.pmod(F.xxhash64("id"), spread(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), spread(n) - 1))
    is_minor = F.col("root") != F.col("major")
    columns = ["id", "n", "pos", "root", "bits"]
    x = lists.where(is_minor).select("h", spot("minor").alias("a"), every("size").alias("b"), F.lit(0).alias("side"),
                                     F.lit(True).alias("minor"), *columns)
    y = lists.select("h", every("minor").alias("a"), spot("size").alias("b"), F.lit(1).alias("side"),
                     is_minor.alias("minor"), *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])

        def pairs() -> pa.RecordBatch:
            x, y = ({name: np.array([r[k] for r in side]) for k, name in enumerate(("minor", "id", "n", "pos", "root"))}
                    | {"bits": [r[5] for r in side]} for side in sides)
            r, c = _allowed_in_block(x, y, least)
            ids = np.unique(np.sort(np.stack([x["id"][r], y["id"][c]]), axis=0), axis=1) if len(r) else np.empty((2, 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ids[0]), pa.array(ids[1])], names=["q", "d"])

        for batch in batches:
            plain = [batch.column(k).to_pylist() for k in range(9)]
            for *place, side, minor, doc, n, pos, root, own in zip(*plain, batch.column(9), strict=True):
                if place != key:
                    if sides[0] and sides[1]:
                        yield pairs()
                    key, sides = place, ([], [])
                sides[side].append((minor, doc, n, pos, root, np.asarray(own.values).view(np.uint64)))
        if sides[0] and sides[1]:
            yield pairs()

    return (x.unionByName(y).repartition("h", "a", "b").sortWithinPartitions("h", "a", "b", "side")
            .mapInArrow(run, "q long, d long"))


def verify(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The links (a, b) among candidate ``pairs`` (q, d); ``sets``: (id, shingles)."""
    degree = pairs.groupBy("q").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    queries = degree.select("q", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block")) \
        .join(sets.withColumnRenamed("id", "q"), "q").select("q", "block", F.lit(None).cast("long").alias("d"), "shingles")
    blocked = pairs.join(degree, "q").select("q", F.pmod(F.xxhash64("d"), F.col("blocks")).cast("int").alias("block"), "d")
    others = blocked.join(sets.withColumnRenamed("id", "d"), "d").select("q", "block", "d", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, ids, others = None, [], [], []

        def links() -> pa.RecordBatch:
            found = sorted({ids[k] for own in query for k in divide_skip(own, others, least)}) if others else []
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(found), pa.int64()),
                                               pa.array(found, pa.int64())], names=["a", "b"])

        for batch in batches:
            for q, block, d, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (q, block) != key:
                    if query and others:
                        yield links()
                    key, query, ids, others = (q, block), [], [], []
                own = np.frombuffer(blob, np.uint64)
                if d is None:
                    query.append(own)
                else:
                    ids.append(d)
                    others.append(own)
                    if len(others) >= 2 * BLOCK:
                        yield links()
                        ids, others = [], []
        if query and others:
            yield links()

    return (queries.unionByName(others).repartition("q", "block")
            .sortWithinPartitions("q", "block", F.col("d").asc_nulls_first()).mapInArrow(run, "a long, b long"))


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, shingles): the whole sets of the wanted ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in length_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                sets = [own.tobytes() for own in shingles(part.column(0).to_pylist(), width)]
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(sets, pa.binary())], names=["id", "shingles"])

    # Few ids go to the documents; many meet them by shuffle.
    wanted = F.broadcast(wanted) if wanted.count() <= FEW_IDS else wanted
    return docs.select("text", "id").join(wanted, "id", "left_semi").select("text", "id").mapInArrow(
        run, "id long, shingles binary").where(F.octet_length("shingles") > 0)


def jaccard_components(docs: DataFrame, width: int = 5, least: int = 75, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, class_id, component_id."""
    every = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = every.where(F.col("id").isNotNull())
    rows = stored(signatures(every, width, least), "jaccard-signatures")
    signed = rows.where(F.col("id").isNotNull())
    classes = stored(attach_group(signed.where("n > 0").select("id", "n", "fp"), ["fp"], ["id"],
                                  {"rep": ("min", F.min("id"))}).select("id", "n", "fp", "rep"), "jaccard-classes")
    size = signed.agg(F.sum(F.size("rare"))).first()[0] or 0
    rare = shared_postings(signed.select(F.posexplode("rare").alias("pos", "h"), "id"), size)
    often = signed.select(F.posexplode("often").alias("pos", "h"), "id", F.size("rare").alias("k"))
    lists = rare.unionByName(often.select("h", "id", (F.col("pos") + F.col("k")).alias("pos")))
    lists = (lists.join(classes.select("id", "n", "rep").distinct(), "id")
             .groupBy("h", F.col("rep").alias("id"), "n").agg(F.min("pos").alias("pos")))
    lists = stored(lists, "jaccard-lists")
    leaders = lists.groupBy("h").agg(F.min(F.struct("id", "n", "pos")).alias("y"), F.count(F.lit(1)).alias("c")).where("c > 1")
    # One bitmap a class, under the class's id (any member's task may have written it).
    bits = stored(signed.where(F.col("bits").isNotNull()).dropDuplicates(["fp"]).select("fp", "n", "bits")
                  .join(classes.select("fp", F.col("rep").alias("id")).distinct(), "fp").drop("fp"), "jaccard-bitmaps")

    def allowed(pairs: DataFrame) -> DataFrame:
        x = bits.select(F.col("id").alias("q"), F.struct("n", "bits").alias("x"))
        y = bits.select(F.col("id").alias("d"), F.struct("n", "bits").alias("y"))
        return pairs.join(x, "q").join(y, "d").where(_bitmaps_allow("x", "y", least)).select("q", "d").distinct()

    # First step: every class and the leader it shares most short lists with.
    met = (lists.select("h", F.col("id").alias("d"), F.struct("n", "pos").alias("x")).join(leaders, "h")
           .where((F.col("d") != F.col("y.id")) & _bound("x", "y", least))
           .groupBy("d", F.col("y.id").alias("q")).agg(F.count(F.lit(1)).alias("c"))
           .groupBy("d").agg(F.min(F.struct((-F.col("c")).alias("c"), "q")).alias("top")).select(F.col("top.q").alias("q"), "d"))
    stars = stored(allowed(met), "jaccard-stars")

    def linked(pairs: DataFrame) -> DataFrame:
        ids = stored(pairs.select("q").union(pairs.select("d")).distinct().toDF("id"), "jaccard-ids")
        return stored(verify(pairs, stored(shingle_sets(named, ids, width), "jaccard-sets"), least), "jaccard-links")

    links = linked(stars)
    near = components(links)
    # Second step: lists that still hold several components, their minority against the rest.
    placed = lists.join(near.select(F.col("node").alias("id"), "root"), "id", "left") \
        .withColumn("root", F.coalesce("root", "id"))
    mixed = placed.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("h")
    open_ = stored(placed.join(mixed, "h", "left_semi"), "jaccard-open")
    major = stored(open_.groupBy("h", "root").agg(F.count(F.lit(1)).alias("c"))
                   .groupBy("h").agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("size"))
                   .select("h", F.col("top.root").alias("major"), "size", (F.col("size") - F.col("top.c")).alias("minor")),
                   "jaccard-major")
    short = major.where(F.col("size") <= SHORT_LIST)
    x = open_.join(short, "h").where("root <> major").select("h", F.struct("id", "n", "pos", "root", "major").alias("x"))
    y = open_.select("h", F.struct("id", "n", "pos", "root").alias("y"))
    crossed = (x.join(y, "h").where((F.col("x.root") != F.col("y.root")) & _bound("x", "y", least)
                                    & ((F.col("y.root") == F.col("x.major")) | (F.col("x.id") < F.col("y.id"))))
               .select(F.least("x.id", "y.id").alias("q"), F.greatest("x.id", "y.id").alias("d")).distinct())
    long = open_.join(major.where(F.col("size") > SHORT_LIST), "h").join(bits, ["id", "n"])
    crossed = allowed(crossed).unionByName(crossed_in_blocks(long, least)).distinct()
    more = linked(stored(crossed, "jaccard-crossed"))
    roots = components(links.unionByName(more))
    # Rows of one id (repeated ids) and of one class share a root.
    ties = classes.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    if not ties.isEmpty():
        roots = components(links.unionByName(more).unionByName(ties))
    alone = rows.select("id", "n").where("n = 0 or id is null").withColumns({"rep": F.col("id"), "root": F.col("id")})
    found = salted_lookup(classes, ["rep"], ["id"], classes.select("rep").distinct().join(
        roots.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("root", "rep").alias("root")))
    out = alone.unionByName(found.select("id", "n", "rep", "root"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"),
                      F.col("root").alias("component_id"))


def keep_one_of_near(docs: DataFrame, width: int = 5, least: int = 75) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, rows without an id and rows without
    words, with their columns as they are.

    Rows are judged one by one: where different texts share an id, each (id, text) is numbered in the order of the
    ids, and the numbers are joined instead."""
    own = spare_names(docs, "key", "digest")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    slim = docs.select(F.col("doc_id").cast("long").alias("id"), digest.alias("digest")).where("id IS NOT NULL").distinct()
    if slim.groupBy("id").count().where("count > 1").isEmpty():
        gone = jaccard_components(docs.select("doc_id", "text"), width, least).where("component_id < doc_id")
        return (docs.withColumn(own[0], id_key("doc_id"))
                .join(gone.select(id_key("doc_id").alias(own[0])).distinct(), own[0], "left_anti").select(*columns_of(docs)))
    numbers = stored(slim.repartitionByRange("id", "digest").sortWithinPartitions("id", "digest")
                     .withColumn("number", F.monotonically_increasing_id()), "jaccard-numbers")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), digest.alias("digest"), "text").join(numbers, ["id", "digest"])
    found = jaccard_components(rows.select(F.col("number").alias("doc_id"), "text"), width, least)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("number")).distinct().join(numbers, "number")
    keyed = docs.withColumns(dict(zip(own, (id_key("doc_id"), digest), strict=True)))
    return (keyed.join(gone.select(id_key("id").alias(own[0]), F.col("digest").alias(own[1])), own, "left_anti")
            .select(*columns_of(docs)))
