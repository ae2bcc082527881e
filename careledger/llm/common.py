"""Helpers the training-data operators share."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.session import ensure_checkpoint_dir

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, return.
SPACES = "[\\x20\\x09-\\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so a
    lost executor costs a re-read and not a re-computation."""
    path = shared_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that Spark hands to a Python worker at a time: texts may be long, and executors hold several workers.
ARROW_ROWS = 1000


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, where the cluster has not installed it, and keep
    the batches that go to them small (a smaller setting of the session stays)."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if rows <= 0 or rows > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context = spark.sparkContext
    on_path = root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or os.getcwd() == root
    if on_path or getattr(context, "_careledger_shipped", False):
        return
    with tempfile.TemporaryDirectory() as folder:           # on the driver; Spark serves the file to the executors
        archive = shutil.make_archive(f"{folder}/careledger-code", "zip", root, "careledger")
        context.addPyFile(archive)
    context._careledger_shipped = True


def id_key(col: str | Column) -> Column:
    """A join key that is never null, so rows without an id keep their decisions."""
    return F.coalesce(F.col(col).cast("string") if isinstance(col, str) else col.cast("string"), F.lit("null"))


def spare_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names for own use that clash with none of ``df``, whatever the case."""
    taken, out = {c.casefold() for c in df.columns}, []
    for name in wanted:
        while name.casefold() in taken:
            name = f"_{name}"
        taken.add(name.casefold())
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    """The columns of ``df`` by their plain names (which may hold dots)."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def attach_group(rows: DataFrame, keys: list[str], salt_on: list[str], aggs: dict[str, tuple[str, Column]],
                 salts: int = 64) -> DataFrame:
    """``rows`` with aggregates of their group, safe for a group that holds a third of all rows.

    Every group is cut into ``salts`` parts by a hash of ``salt_on``.  The parts
    are aggregated first (map side, then per part), the few part rows merge into
    the group row, the group row goes back to the parts, and the rows join on
    (keys, part), so that no join task sees a whole hot group.

    ``aggs`` maps an output name to (merge function, partial aggregate); the
    merge function is one of min, max, sum.  Keys must not be null.
    """
    salted = rows.withColumn("_part", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    parts = salted.groupBy(*keys, "_part").agg(*[a.alias(n) for n, (_, a) in aggs.items()])
    groups = parts.groupBy(*keys).agg(*[getattr(F, how)(n).alias(n) for n, (how, _) in aggs.items()])
    heads = parts.select(*keys, "_part").join(groups, keys)
    return salted.join(heads, [*keys, "_part"]).drop("_part")


def salted_lookup(rows: DataFrame, keys: list[str], salt_on: list[str], table: DataFrame, how: str = "inner",
                  salts: int = 64) -> DataFrame:
    """``rows`` joined with ``table`` (one row a key) by way of (key, part) rows, so that no task sees a
    whole hot key.  Keys must not be null."""
    salted = rows.withColumn("_part", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    heads = salted.select(*keys, "_part").distinct().join(table, keys)
    return salted.join(heads, [*keys, "_part"], how).drop("_part")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: Byte classes: blanks of the contracts end a word.
_BLANKS = np.zeros(256, bool)
_BLANKS[list(b" \t\n\x0b\x0c\r")] = True
_ODD = 0x9E3779B97F4A7C15
_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))
_WORD_BYTES = 1 << 20


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant and of its inverse modulo 2 ** 64."""
    def powers(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(_ODD), powers(pow(_ODD, -1, 1 << 64))


def _word_hashes(x: np.ndarray, stems: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, stem hashes) of every word of a buffer that ends in a blank: a polynomial over the word's
    bytes, by differences of one running sum, then mixed with the length.  Stems are the first bytes of longer
    words; 0 where a word is not longer."""
    blank = _BLANKS[x]
    up, down = _powers(max(1 << (len(x) - 1).bit_length(), 2 * _WORD_BYTES))
    sums = np.cumsum(np.where(blank, np.uint64(0), _BYTE_VALUES[x]) * up[:len(x)], dtype=np.uint64)
    before = np.concatenate([[True], blank[:-1]])
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    low = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    sizes = (ends - starts).astype(np.uint64)
    beginnings = np.zeros((len(starts), len(stems)), np.uint64)
    for k, n in enumerate(stems):
        long = np.flatnonzero(sizes > n)
        at = starts[long]
        beginnings[long, k] = mixed((sums[at + n - 1] - low[long]) * down[at] + np.uint64(n << 32))
    return mixed((sums[ends - 1] - low) * down[starts] + sizes), starts, beginnings


def word_hashes(parts: list[bytes], stems: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all parts one after the other, how many words each part has, and stem hashes.

    Long parts are cut at blanks, so memory does not grow with a text beyond its hashes."""
    counts = np.zeros(len(parts), np.int64)
    out, beginnings = [np.empty(0, np.uint64)], [np.empty((0, len(stems)), np.uint64)]
    some, owners, size = [], [], 0

    def flush() -> None:
        nonlocal some, owners, size
        if some:
            h, starts, first = _word_hashes(np.frombuffer(b"\n".join([*some, b""]), np.uint8), stems)
            ends = np.cumsum([len(p) + 1 for p in some])
            np.add.at(counts, np.array(owners), np.diff(np.concatenate([[0], np.searchsorted(starts, ends)])))
            out.append(h)
            beginnings.append(first)
        some, owners, size = [], [], 0

    for k, part in enumerate(parts):
        at = 0
        while at < len(part):
            end = at + _WORD_BYTES
            while end < len(part) and not _BLANKS[part[end]]:
                end += 1
            some.append(part[at:end])
            owners.append(k)
            size += end - at
            at = end
            if size >= _WORD_BYTES:
                flush()
    flush()
    return np.concatenate(out), counts, np.concatenate(beginnings)


#: ASCII punctuation and control characters.
_PUNCTUATION = bytes(c for c in range(128) if not chr(c).isalnum() and c not in b" \t\n\x0b\x0c\r")


def plain_bytes(text: str | None) -> bytes:
    """The text without case and ASCII punctuation."""
    return (text or "").casefold().encode("utf-8").translate(None, _PUNCTUATION)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (order matters)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0xD1342543DE82EF95) + words[i:len(words) - n + 1 + i]
    return mixed(out + np.uint64(n))


def length_slices(texts: pa.Array, most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes (one row at least): bounds a task's memory."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += int(n)
    if start < len(sizes):
        yield start, len(sizes)
