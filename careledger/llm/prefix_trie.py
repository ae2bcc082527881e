"""Operator 13, the prefix trie of conversations by a splitter skeleton.

A conversation is the path of its turns, written as one digest of 128 bits a
turn, so that conversations that begin alike sort side by side.

1. Splitters are quantiles of a sample of (path, conv_id), weighted by turns.
   The trie of the splitters' paths is the skeleton: its nodes are the only ones
   whose conversations can lie in more than one range (a path that a third of all
   conversations share is cut by conv_id, and its nodes belong to the skeleton).
   It is broadcast, and bounded: ``MOST_SHARDS`` splitters, ``SKELETON_BYTES`` of
   paths, beyond which every second splitter is left out.
2. Rows are dealt to their ranges and sorted; a task reads its shard once, with a
   stack of the open nodes, and finishes all other nodes.  A second pass over the
   shard's own nodes, sorted as they were opened, hands parents' ids down.
3. For skeleton nodes a shard gives partial aggregates, which a grouped reduction
   combines; what hangs below them is then summed up the skeleton, which is as
   small as what was broadcast.  The ids of conversations that end in a skeleton
   node go to its digest in order, in chunks of ``CHUNK`` bytes.

A task's memory is one path with its stack, whatever the size of a shard or a
node.  A conversation is a unit, as a text is: its turns meet in one row, without
their texts.

Defined results: turns are ordered by ``turn`` (null first), turns of equal number
by the digest of role and text, and rows that repeat are turns of their own; a null
role or text is empty; rows without a conv_id belong to no conversation; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import stored

DIGEST = 32                 # characters of a turn's digest
TURNS_A_SHARD = 20_000
MOST_SHARDS = 4096
DRAWS = 20                  # sampled paths for each shard
SPLITTER_CHARS = 1 << 20    # paths over this size are no splitters
SAMPLE_CHARS = 64 << 20     # of sampled paths on the driver
SKELETON_BYTES = 64 << 20
CHUNK = 32_768
NODE, PARTIAL, ENDS = 0, 1, 2
FIELDS = ("kind int, shard int, number long, parent long, top_first int, top_depth int, depth long, conv_id long, "
          "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends_sha256 string, "
          "chunk binary, parent_conv_id long")
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]
_TYPES = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]
          for f in FIELDS.split(", ")]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def rebuilt(conversations: DataFrame, family: int = 5, shared: int = 9) -> DataFrame:
    """(conv_id, path, sizes): the first h = crc32(conv_id) % ``shared`` turns of the family's first conversation,
    then the conversation's own turns after its first h."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.expr(f"conv_id - conv_id % {family}").cast("long").alias("family"), F.col("conv_id").cast("long").alias("conv"),
        F.struct(F.col("turn").alias("turn"),
                 F.left(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256),
                        F.lit(DIGEST)).alias("digest"),
                 F.octet_length(text).cast("long").alias("size")).alias("t"))
    whole = turns.repartition("family").groupBy("family", "conv").agg(F.sort_array(F.collect_list("t")).alias("own"))
    first = whole.where("conv = family").select("family", F.slice("own", 1, shared - 1).alias("base"))
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(shared)).cast("int")
    path = F.concat(F.slice(F.coalesce("base", F.slice("own", 1, 0)), F.lit(1), F.col("h")),
                    F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0))))
    return (whole.join(first, "family", "left").withColumn("h", h).select(F.col("conv").alias("conv_id"), path.alias("path"))
            .select("conv_id", F.array_join(F.transform("path", lambda t: t["digest"]), "").alias("path"),
                    F.transform("path", lambda t: t["size"]).alias("sizes")))


def common_turns(a: str, b: str) -> int:
    """How many turns two paths share."""
    n, most = 0, min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // DIGEST
    while a[n:n + DIGEST] == b[n:n + DIGEST]:
        n += DIGEST
    return n // DIGEST


@dataclass
class Skeleton:
    """Sorted splitters; ``first[k][d]``: the first splitter that shares d turns with splitter k and all between,
    so that (first, d) names a node of the skeleton."""
    splitters: list[tuple[str, int]]
    first: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        for k, (path, _) in enumerate(self.splitters):
            own = np.full(len(path) // DIGEST + 1, k, np.int32)
            if k:
                n = common_turns(self.splitters[k - 1][0], path) + 1
                own[:n] = self.first[-1][:n]
            self.first.append(own)

    def around(self, shard: int) -> list[int]:
        """The splitters at the two ends of a shard."""
        return [k for k in (shard - 1, shard) if 0 <= k < len(self.splitters)]

    def above(self, first: int, depth: int) -> tuple[int, int]:
        return int(self.first[first][depth - 1]) if self.first else 0, depth - 1


def skeleton_of(paths: DataFrame) -> Skeleton:
    """Splitters from a weighted sample of the paths: ``DRAWS`` a shard and about ``SAMPLE_CHARS`` of them at most, so
    bounded, and the same in every run."""
    weight = F.greatest(F.size("sizes"), F.lit(1)).cast("double")
    total, chars = paths.agg(F.sum(weight).cast("long"), F.sum(weight * F.length("path"))).first()
    shards = min(MOST_SHARDS, -(-(total or 0) // TURNS_A_SHARD))
    if shards < 2:
        return Skeleton([])
    rate = min(1.0, DRAWS * shards / total, SAMPLE_CHARS / max(chars, 1.0))
    chance = F.pmod(F.xxhash64("conv_id", F.lit("splitter")), F.lit(1 << 40)) / float(1 << 40)
    drawn = sorted((r["path"], r["conv_id"], max(r["w"], 1 / rate)) for r in
                   paths.where((chance < weight * rate) & (F.length("path") <= SPLITTER_CHARS))
                   .select("path", "conv_id", weight.alias("w")).collect())
    if not drawn:
        return Skeleton([])
    sums = np.cumsum([w for _, _, w in drawn])
    at = np.unique(np.searchsorted(sums, sums[-1] * np.arange(1, shards) / shards))
    splitters = [drawn[k][:2] for k in at.tolist()]
    while sum(len(p) for p, _ in splitters) > SKELETON_BYTES:
        splitters = splitters[::2]
    return Skeleton(splitters)


class _Rows:
    """Rows on their way out, a batch of them at a time."""

    def __init__(self, most: int = 5_000):
        self.rows: list[tuple] = []
        self.most = most

    def add(self, kind, shard, number, parent=None, top=(None, None), depth=None, conv_id=None, n=None, children=None,
            leaves=None, saved=None, size=None, ends=None, chunk=None) -> None:
        self.rows.append((kind, shard, number, parent, *top, depth, conv_id, n, children, leaves, saved, size, ends, chunk, None))

    def take(self, all_: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (all_ or len(self.rows) >= self.most):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows), _TYPES, strict=True)],
                                             names=_NAMES)
            self.rows = []


class _Node:
    """An open node: sums over what has been closed below it."""
    __slots__ = ("number", "size", "top", "n", "low", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, number: int, size: int, top: tuple[int, int] | None):
        self.number, self.size, self.top = number, size, top
        self.n = self.children = self.leaves = self.saved = 0
        self.low, self.ends, self.waiting = None, None, []


class ShardScan:
    """One pass over the sorted paths of a shard."""

    def __init__(self, skeleton: Skeleton, rows: _Rows):
        self.skeleton, self.rows, self.shard, self.stack, self.count = skeleton, rows, None, [], 0

    def begin(self, shard: int) -> None:
        self.finish()
        self.shard, self.path, self.count = shard, "", 0
        self.ends = [(k, self.skeleton.splitters[k][0]) for k in self.skeleton.around(shard)]
        self._open(0, (0, 0))

    def finish(self) -> None:
        if self.shard is not None:
            self._close(0)
            self.shard = None

    def _open(self, size: int, top: tuple[int, int] | None) -> None:
        self.stack.append(_Node(self.count, size, top))
        self.count += 1

    def add(self, path: str, conv: int, sizes: list[int]) -> None:
        same = common_turns(path, self.path)
        self._close(same + 1)
        if len(sizes) > same:
            on = [(common_turns(path, p), k) for k, p in self.ends]
            for depth in range(same + 1, len(sizes) + 1):
                k = next((k for n, k in on if n >= depth), None)
                self._open(sizes[depth - 1], None if k is None else (int(self.skeleton.first[k][depth]), depth))
        self.path = path
        node = self.stack[-1]
        node.n += 1
        node.low = conv if node.low is None else min(node.low, conv)
        if node.top is None:
            if node.ends is None:
                node.ends = hashlib.sha256(b"%d" % conv)
            else:
                node.ends.update(b",%d" % conv)
        else:
            node.waiting.append(b"%d" % conv)
            if len(node.waiting) * 8 >= CHUNK:
                self._send(node)

    def _send(self, node: _Node) -> None:
        """Ids that end in a skeleton node, in order (numbers of chunks go on in the order of the scan)."""
        if node.waiting:
            self.rows.add(ENDS, self.shard, self.count, top=node.top, chunk=b",".join(node.waiting))
            self.count += 1
            node.waiting = []

    def _close(self, depth: int) -> None:
        """Close all nodes from ``depth`` down."""
        while len(self.stack) > depth:
            node = self.stack.pop()
            above = self.stack[-1] if self.stack else None
            if above is not None:
                above.n += node.n
                above.low = node.low if above.low is None else min(above.low, node.low)
            if node.top is not None:
                self._send(node)
                self.rows.add(PARTIAL, self.shard, node.number, top=node.top, conv_id=node.low, n=node.n,
                              children=node.children, leaves=node.leaves, saved=node.saved, size=node.size)
                continue
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * node.size
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            parent = (-1, above.top) if above.top is not None else (above.number, (None, None))
            self.rows.add(NODE, self.shard, node.number, *parent, len(self.stack), node.low, node.n, node.children, leaves,
                          saved, node.size, NO_ENDS if node.ends is None else node.ends.hexdigest())


def shard_nodes(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """``FIELDS``: the finished nodes of every shard, partial aggregates and chunks of ends of skeleton nodes."""
    sent = paths.sparkSession.sparkContext.broadcast(skeleton)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = sent.value.splitters
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True)
            shard = pa.array([bisect_right(splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=["conv_id", "path", "sizes", "shard"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows()
        shards = ShardScan(sent.value, rows)
        for batch in batches:
            for conv, path, sizes, shard in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != shards.shard:
                    shards.begin(shard)
                shards.add(path, conv, sizes)
                yield from rows.take()
        shards.finish()
        yield from rows.take(all_=True)

    dealt = paths.select("conv_id", "path", "sizes").mapInArrow(deal, "conv_id long, path string, sizes array<long>, shard int")
    sorted_ = dealt.repartitionById(len(skeleton.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    return sorted_.mapInArrow(scan, FIELDS).sortWithinPartitions("shard", "number").mapInArrow(_hand_down, FIELDS)


def _hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parent's conv_id for every node below a finished one: parents come first."""
    shard, stack = None, []                                     # (number, conv_id) of the nodes above
    for batch in batches:
        out = []
        kind, at, number, parent, conv = (batch.column(_NAMES.index(c)).to_pylist()
                                          for c in ("kind", "shard", "number", "parent", "conv_id"))
        for row in zip(kind, at, number, parent, conv, strict=True):
            if row[1] != shard:
                shard, stack = row[1], []
            if row[0] != NODE:
                out.append(None)
                continue
            while stack and stack[-1][0] != row[3]:
                stack.pop()
            out.append(stack[-1][1] if stack else None)
            stack.append((row[2], row[4]))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.int64())], names=_NAMES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the chunks of each skeleton node, which come in order."""
    now, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()),
                                           pa.array([state.hexdigest()])], names=["top_first", "top_depth", "ends"])

    for batch in batches:
        for first, depth, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4), strict=True):
            if now == (first, depth):
                state.update(b",")
            else:
                if now:
                    yield row()
                now, state = (first, depth), hashlib.sha256()
            state.update(chunk.as_py())
    if now:
        yield row()


def skeleton_nodes(nodes: DataFrame, skeleton: Skeleton) -> pa.Table:
    """The skeleton's nodes: partial aggregates reduced in Spark, then summed from the deepest up."""
    top = ["top_first", "top_depth"]
    sums = nodes.where(f"kind = {PARTIAL}").groupBy(*top).agg(
        F.sum("n_convs").alias("n"), F.min("conv_id").alias("low"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("size").alias("size"))
    digests = (nodes.where(f"kind = {ENDS}").select(*top, "shard", "number", "chunk").repartition(*top)
               .sortWithinPartitions(*top, "shard", "number").mapInArrow(_digests, "top_first int, top_depth int, ends string"))
    found = {(r["top_first"], r["top_depth"]): r.asDict() for r in sums.join(digests, top, "left").collect()}
    for key in sorted(found, key=lambda k: -k[1]):
        node = found[key]
        node["leaves"] = node["leaves"] if node["children"] else 1
        node["saved"] += (node["n"] - 1) * node["size"]
        if key[1]:
            above = found[skeleton.above(*key)]
            node["parent"] = above["low"]
            above["children"] += 1
            above["leaves"] += node["leaves"]
            above["saved"] += node["saved"]
    columns = {"top_first": 0, "top_depth": 1}
    out = {n: pa.array([k[i] for k in found], pa.int32()) for n, i in columns.items()}
    for name, source in (("conv_id", "low"), ("parent_conv_id", "parent"), ("n_convs", "n"), ("n_children", "children"),
                         ("n_leaves", "leaves"), ("saved_tokens", "saved")):
        out[name] = pa.array([v.get(source) for v in found.values()], pa.int64())
    out["ends_sha256"] = pa.array([v["ends"] or NO_ENDS for v in found.values()], pa.string())
    return pa.table(out)


OUTPUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame, family: int = 5, shared: int = 9) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: ``OUTPUT``."""
    spark = conversations.sparkSession
    paths = stored(rebuilt(conversations, family, shared), "trie-paths")
    skeleton = skeleton_of(paths)
    nodes = stored(shard_nodes(paths, skeleton), "trie-nodes")
    tops = skeleton_nodes(nodes, skeleton)
    # As small as the skeleton that was broadcast.
    tops = spark.createDataFrame(tops, "top_first int, top_depth int, conv_id long, parent_conv_id long, n_convs long, "
                                       "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    above = F.broadcast(tops.select("top_first", "top_depth", F.col("conv_id").alias("above")))
    own = nodes.where(f"kind = {NODE}").join(above, ["top_first", "top_depth"], "left").withColumn(
        "parent_conv_id", F.coalesce("above", "parent_conv_id"))
    return own.select(*OUTPUT).unionByName(tops.withColumn("depth", F.col("top_depth").cast("long")).select(*OUTPUT))
