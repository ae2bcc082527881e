"""Corpus-wide values for what a block of documents holds.

Some operators need, for every document, numbers that only the whole corpus
knows about the things in it (how often a word occurs, in how many documents a
pair does).  A row for each document and thing would be the corpus over again
in a shuffle, and frequent things would be hot keys.  So a task reads documents
in blocks of ``BLOCK_BYTES`` and writes, once, into the shared folder:

* an entry (block, place, key, n) for each different thing of the block;
* a head (block, blob, n): ids and documents, which name things by their places.

Entries are reduced by key to a table of the corpus and join that table, one
row a block at most for the most frequent key; the answers go back to their
block, in no order, where their places say which is which.  Rows are sorted by
block alone, one number, which Spark sorts without comparing rows.  What a task
holds is one block.  A document longer than a block is a block by itself.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 8 << 20
LAST = 2**31 - 1        # the place of heads


def block_schema(key_type: T.DataType) -> T.StructType:
    """No list among the columns: Spark counts through all rows of an Arrow batch for each null list it adds."""
    return T.StructType([T.StructField("block", T.LongType(), False), T.StructField("place", T.IntegerType(), False),
                         T.StructField("key", key_type), T.StructField("n", T.LongType(), False),
                         T.StructField("blob", T.BinaryType())])


def pack(*arrays: np.ndarray | pa.Array) -> bytes:
    raw = pickle.dumps(arrays, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray | pa.Array, ...]:
    size = int.from_bytes(blob[:8], "little")
    return pickle.loads(pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True))


class Block:
    """The documents that a task holds at the moment."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.bytes = self.docs = 0

    def add(self, ids: pa.Array, size: int) -> None:
        self.ids.append(ids)
        self.docs += len(ids)
        self.bytes += size


def block_numbers() -> Iterator[int]:
    """Numbers that no other task of the job gives (a task that is run again gives the same)."""
    first = TaskContext.get().partitionId() << 32
    return iter(range(first, first + (1 << 32)))


def entry_batches(block: int, keys: pa.Array, n: np.ndarray, head_n: int, blob: bytes,
                  most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """The rows of one block: entries in the order of their places, and the head, whose blob is packed with the ids first."""
    names = ["block", "place", "key", "n", "blob"]
    for a in range(0, len(keys), most):
        size = min(most, len(keys) - a)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(size, block)), pa.array(np.arange(a, a + size, dtype=np.int32)), keys.slice(a, size),
            pa.array(n[a:a + size].astype(np.int64)), pa.nulls(size, pa.binary())], names=names)
    yield pa.RecordBatch.from_arrays([
        pa.array([block], pa.int64()), pa.array([LAST], pa.int32()), pa.nulls(1, keys.type),
        pa.array([head_n], pa.int64()), pa.array([blob], pa.binary())], names=names)


def entries(blocks: DataFrame) -> DataFrame:
    return blocks.where("key IS NOT NULL").select("block", "place", "key", "n")


def answer(blocks: DataFrame, table: DataFrame, values: list[str],
           finish: Callable[[list[np.ndarray], pa.Array, tuple[np.ndarray, ...]], dict[str, pa.Array]],
           schema: T.StructType) -> DataFrame:
    """Rows that ``finish(values by place, ids, unpacked blob)`` makes of every block.

    ``table`` has one row for each key of the entries, with the columns ``values``."""
    fields = {f.name: f.dataType for f in table.schema.fields}
    found = entries(blocks).select("block", "place", "key").join(table, "key").select(
        "block", "place", *values, F.lit(None).cast("binary").alias("blob"))
    heads = blocks.where("key IS NULL").select(
        "block", "place", *(F.lit(None).cast(fields[v]).alias(v) for v in values), "blob")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[] for _ in range(len(values) + 1)]
        head = b""

        def answered() -> pa.RecordBatch:
            places, *found = (np.concatenate(p) for p in parts)
            by_place = [np.empty_like(f) for f in found]
            for placed, f in zip(by_place, found, strict=True):
                placed[places] = f
            ids, *blob = unpack(head)
            rows = finish(by_place, ids, tuple(blob))
            return pa.RecordBatch.from_arrays([rows[n] for n in names], names=names)

        now = None
        for batch in batches:
            block = np.asarray(batch.column(0))
            starts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist()] if len(block) else []
            for a, b in zip(starts, [*starts[1:], len(block)], strict=False):
                if now is not None and block[a] != now:
                    yield answered()
                    parts, head = [[] for _ in parts], b""
                now, rows = block[a], batch.slice(a, b - a)
                place = np.asarray(rows.column(1))
                at = np.flatnonzero(place == LAST)
                if len(at):
                    i = int(at[0])
                    head = rows.column(len(values) + 2)[i].as_py()
                    rows = pa.concat_batches([rows.slice(0, i), rows.slice(i + 1)])
                for k, p in enumerate(parts):
                    p.append(rows.column(k + 1).to_numpy(zero_copy_only=False))
        if now is not None:
            yield answered()

    return found.unionByName(heads).repartition("block").sortWithinPartitions("block").mapInArrow(run, schema)
