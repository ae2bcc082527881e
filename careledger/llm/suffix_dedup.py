"""Operator 5, removal of repeated passages by external induced suffix sorting.

Every byte that a ``width``-byte string covers goes, if that string also starts in
a document with a smaller id.

1. Anchors route equal strings to one place: of the hashes of all grams (strings
   of ``gram_of(width)`` bytes) inside a window of ``width`` bytes the smallest is the window's anchor,
   so equal windows have equal anchors.  Anchor hashes are counted by shuffle;
   those that occur once anywhere are of no use.  What occurs more often is kept
   as a bitmap of at most ``MOST_BITS`` bits (false hits only cost work).
2. A stretch is a run of windows with one anchor.  Stretches whose anchor may
   repeat go to the anchor's shard.
3. Stretches of an anchor that are all the same repeat as a whole.  Where they
   differ, windows whose hash occurs once are out and what is left falls into pieces, of
   which the same holds.  A shard concatenates the different pieces of an anchor and sorts all their suffixes
   by external induced sorting (``induced_sort``), whose long queues wait on disk;
   the shard's text, arrays and members are in memory.  Suffixes that share ``width`` bytes stand together,
   their common prefixes say where such a group ends, and the smallest id of a
   group decides for every member which of its windows repeat.
4. The covered ranges join their documents, overlapping ranges unite, and the rest
   of the bytes stays.

Defined results: texts are UTF-8 bytes, a null text has none; matches never cross
documents.  Rows that repeat an id are not earlier than each other.  A row
without an id keeps all its bytes and is not earlier than any.  Texts below
``width`` bytes are left alone.  An empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careledger.llm.common import id_key, length_slices, mixed, stored
from careledger.llm.induced_sort import sorted_suffixes

GRAM = 16                   # bytes of a gram, at least
PIECE = 1 << 16             # bytes whose anchors are searched at a time
SLICE = 1 << 20             # bytes of text that a task unpacks at a time
SHARD_BYTES = 4 << 20       # input bytes a shard stands for
TASK_BYTES = 64 << 20       # input bytes a task stands for: its shards are sorted in turn
MOST_BITS = 30
QUEUE_TUPLES = 1 << 22      # tuples (8 bytes) of the sorter's queues that a task holds; more wait on disk
REMEMBERED = 200_000        # digests of whole texts that a task remembers
HELD = 16 << 20             # bytes of stretches, and of anchors, that a task holds before it writes them


def _pieces(text: bytes, width: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of overlapping pieces that hold every window of the text once."""
    for a in range(0, max(len(text) - width + 1, 0), PIECE):
        yield a, text[a:a + PIECE + width - 1]


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """The smallest (largest) value of every window, by doubling."""
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    return pick(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def gram_of(width: int) -> int:
    """Bytes of a gram: about half a window, in words of eight bytes.  Shorter ones repeat by chance the more the
    larger the corpus is, and each repeat costs work; longer ones lead fewer windows."""
    return max(GRAM, width // 16 * 8)


def _gram_hashes(whole: bytes, gram: int) -> np.ndarray:
    x = np.ndarray((len(whole) - 7,), np.dtype("<u8"), whole, 0, (1,))    # the eight bytes from every position on
    mix = x * np.uint64(0x9E3779B97F4A7C15)
    for further in (*[8] * (gram // 8 - 1), *[gram % 8] * (gram % 8 > 0)):
        mix = (mix[:-further] ^ (mix[further:] >> np.uint64(29))) * np.uint64(0xD1342543DE82EF95) + mix[further:]
    return ((mix ^ (mix >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)


def stretches(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor) of every run of windows with one anchor.

    Window starts count through the concatenated parts; windows stay inside a part."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    whole = b"".join(parts)
    if len(whole) < width:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    gram = gram_of(width)
    low = _slide(_gram_hashes(whole, gram), width - gram + 1, np.minimum)
    starts = np.cumsum(sizes) - sizes
    for start in starts[1:].tolist():                         # windows across the end of a part do not count
        low[max(0, start - width + 1):start] = 0
    new = np.concatenate([[True], low[1:] != low[:-1]])
    new[starts[starts < len(low)]] = True
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(low)))
    there = low[first] > 0
    return first[there], count[there], mixed(low[first[there]])


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    for a, b in length_slices(batch.column(column), SLICE):
        yield batch.slice(a, b - a)


def _grouped(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, column slices...) of each bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = tuple(c[order] for c in columns)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield (int(bucket[a]), *(c[a:b] for c in columns))


def repeated_anchors(texts: DataFrame, width: int, shards: int, bits: int, tasks: int) -> np.ndarray:
    """Bitmap over the leading ``bits`` bits of the hashes of anchors that occur more than once.

    ``tasks`` partitions take the shards in turn; the bits are written to the shared folder and read by one job."""
    shard_bits = shards.bit_length() - 1
    size = max(1, (1 << bits) // shards // 8)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def write() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            rest = (h >> np.uint64(32 - shard_bits)).astype(np.uint32).view(np.int32)      # 32 bits after the shard's
            rows = list(_grouped(_shard_of(h, shard_bits), rest, n))
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1][r[2] == 1] for r in rows], pa.list_(pa.int32())),
                pa.array([r[1][r[2] > 1] for r in rows], pa.list_(pa.int32()))], names=["shard", "once", "more"])

        for batch in batches:
            for part in _slices(batch, 0):
                pieces = [p for t in part.column(0).to_pylist() for _, p in _pieces((t or "").encode("utf-8"), width)]
                for some in _bounded(pieces):
                    held.append(stretches(some, width)[2])
                    count += len(held[-1])
                    if count >= HELD // 8:
                        yield write()
                        held, count = [], 0
        if count:
            yield write()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, more = None, [], []

        def row() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(once), return_counts=True)
            again = np.concatenate([h[n > 1], *more])
            spot = (again >> np.uint32(32 + shard_bits - bits)).astype(np.int64)
            flags = np.zeros(size * 8, bool)
            flags[spot] = True
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()),
                                               pa.array([np.packbits(flags).tobytes()], pa.binary())], names=["shard", "bits"])

        for batch in batches:                                 # rows come by shard
            for shard, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if shard != now:
                    if now is not None:
                        yield row()
                    now, once, more = shard, [], []
                once.append(np.asarray(a.values).view(np.uint32))
                more.append(np.asarray(b.values).view(np.uint32))
        if now is not None:
            yield row()

    counted = stored(texts.mapInArrow(gather, "shard int, once array<int>, more array<int>")
                     .repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(count, "shard int, bits binary"),
                     "suffix-anchors")
    out = np.zeros(size * shards, np.uint8)
    for r in counted.collect():                               # 2 ** bits / 8 bytes in all: 128 MB at most
        out[r.shard * size:(r.shard + 1) * size] = np.frombuffer(r.bits, np.uint8)
    return out


def _bounded(pieces: list[bytes]) -> Iterator[list[bytes]]:
    some, size = [], 0
    for p in pieces:
        if some and size + len(p) > 2 * PIECE:
            yield some
            some, size = [], 0
        some.append(p)
        size += len(p)
    if some:
        yield some


def _shard_of(h: np.ndarray, shard_bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(h), np.int64)


def _spans(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all spans one after the other; some spans at a time, as an index takes eight times their bytes."""
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    cuts = [0, *(np.searchsorted(ends, np.arange(SLICE, len(out), SLICE)) + 1).tolist(), len(size)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            low = int(ends[a] - size[a])
            index = np.repeat(begin[a:b] - (ends[a:b] - size[a:b]), size[a:b])
            out[low:low + len(index)] = flat[index + np.arange(low, low + len(index))]
    return out


_STRETCHES = "shard int, id array<bigint>, fp array<bigint>, at array<int>, size array<int>, text binary"


def repeated_stretches(docs: DataFrame, bitmap, width: int, shards: int, bits: int) -> DataFrame:
    """Per shard: id, fp, offset, size and (compressed) bytes of every stretch whose anchor may repeat.

    Texts that equal one of a smaller id in the same task repeat as a whole: they become an entry of
    size -1 (at: number of bytes) without bytes of their own."""
    shard_bits = shards.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value
        first: dict[bytes, int] = {}
        out: list[tuple[np.ndarray, ...]] = []                # shard, id, fp, offset, size of stretches
        raws: list[np.ndarray] = []                           # and their bytes
        held = 0

        def write() -> pa.RecordBatch:
            shard, *columns = (np.concatenate(c) for c in zip(*out))
            size = np.maximum(columns[3], 0)
            begin = np.cumsum(size) - size
            order = np.argsort(shard, kind="stable")
            shard, size, begin = shard[order], size[order], begin[order]
            text, raw = _spans(np.concatenate([*raws, np.empty(0, np.uint8)]), begin, size), []
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            ends = np.append(np.cumsum(size) - size, size.sum())[cuts].tolist()
            for a, b in zip(ends[:-1], ends[1:]):
                raw.append(pa.compress(text[a:b].tobytes(), "zstd", asbytes=True))
            lists = (pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(c[order], kind)) for c, kind in zip(
                columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(shard[cuts[:-1]], pa.int32()), *lists, pa.array(raw, pa.binary())],
                                              names=["shard", "id", "fp", "at", "size", "text"])

        for batch in batches:
            for part in _slices(batch, 0):
                owners, pieces, copies = [], [], []
                for text, doc, fp in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    raw = (text or "").encode("utf-8")
                    if len(raw) < width:
                        continue
                    digest = hashlib.sha256(raw).digest()
                    if digest in first and first[digest] < doc:
                        copies.append((doc % shards, doc, fp, len(raw), -1))
                        continue
                    if len(first) >= REMEMBERED:              # forgotten copies only cost work
                        first.clear()
                    first.setdefault(digest, doc)
                    for offset, piece in _pieces(raw, width):
                        owners.append((doc, fp, offset))
                        pieces.append(piece)
                if copies:
                    out.append(tuple(np.array(copies, np.int64).T))
                    held += 64 * len(copies)
                done = 0
                for some in _bounded(pieces):
                    at, count, h = stretches(some, width)
                    spot = h >> np.uint64(64 - bits)
                    hit = (known[(spot >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (spot & np.uint64(7))).astype(np.uint8)) & 1
                    at, count, h = at[hit > 0], count[hit > 0], h[hit > 0]
                    begins = np.concatenate([[0], np.cumsum([len(p) for p in some])])
                    which = np.searchsorted(begins, at, side="right") - 1
                    doc, fp, offset = np.array(owners[done:done + len(some)], np.int64).T
                    out.append((_shard_of(h, shard_bits), doc[which], fp[which], offset[which] + at - begins[which], count + width - 1))
                    raws.append(_spans(np.frombuffer(b"".join(some), np.uint8), at, count + width - 1))
                    held += len(raws[-1]) + 40 * len(at)
                    done += len(some)
                    if held >= HELD:
                        yield write()
                        out, raws, held = [], [], 0
        if held:
            yield write()

    return docs.select("text", "id", "fp").mapInArrow(run, _STRETCHES)


def _covered(strings: list[bytes], low: np.ndarray, width: int, folder: str | None) -> tuple[np.ndarray, np.ndarray]:
    """For every start of a window in the strings (concatenated): the smallest id that its group of equal
    windows has, and where each string begins in that numbering."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    text = np.zeros(int(sizes.sum()) + len(strings) + 1, np.uint16)
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    place = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(flat))
    text[:-1] = 1                                             # between strings; 0 only at the very end
    text[place] = flat.astype(np.uint16) + 2
    owner = np.repeat(low, sizes + 1)
    left = np.repeat(begins + sizes, sizes + 1) - np.arange(len(owner))     # bytes up to the string's end
    least = np.full(len(text), np.iinfo(np.int64).max)
    least[:len(owner)] = owner
    pending: list[np.ndarray] = []

    def settle(run: np.ndarray, new: np.ndarray) -> None:
        """Groups within ``run`` begin where ``new``; every member gets the smallest id of its group."""
        first = np.flatnonzero(new)
        small = np.minimum.reduceat(owner[run], first)
        least[run] = np.repeat(small, np.diff(np.append(first, len(run))))

    for at, prefix in sorted_suffixes(text, width, folder, QUEUE_TUPLES):
        whole = at < len(owner)
        whole[whole] = left[at[whole]] >= width
        at, new = at[whole], prefix[whole] < width
        if not len(at):
            continue
        cut = np.flatnonzero(new)
        if not len(cut):
            pending.append(at)
            continue
        before = np.concatenate([*pending, at[:cut[-1]]])
        if len(before):
            starts = np.zeros(len(before), bool)
            starts[0] = True
            starts[len(before) - cut[-1]:] |= new[:cut[-1]]
            settle(before, starts)
        pending = [at[cut[-1]:]]
    last = np.concatenate(pending) if pending else np.empty(0, np.int32)
    if len(last):
        starts = np.zeros(len(last), bool)
        starts[0] = True
        settle(last, starts)
    return least, begins


def repeated_ranges(found: DataFrame, width: int, tasks: int) -> DataFrame:
    """(id, fp, start, stop): byte ranges that repeat, not yet united.  ``tasks`` partitions take the shards in turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                if shard is None or row[0].as_py() != shard.number:
                    if shard is not None:
                        yield from shard.ranges()
                    shard = _Shard(row[0].as_py(), width)
                whole = shard.add(*row[1:])
                if whole is not None:
                    yield whole
        if shard is not None:
            yield from shard.ranges()

    return (found.repartition(tasks, "shard").sortWithinPartitions("shard")
            .mapInArrow(run, "id long, fp long, start long, stop long"))


class _Shard:
    """The stretches of one shard: members (id, fp, offset, string) and the different strings."""

    def __init__(self, number: int, width: int):
        self.number, self.width = number, width
        self.strings: dict[bytes, int] = {}
        self.members: list[list[np.ndarray]] = [[], [], [], []]

    def add(self, *row) -> pa.RecordBatch | None:
        """Take a row of stretches; returns the ranges of its texts that repeat as a whole."""
        ids, fps, ats, sizes = (np.asarray(c.values) for c in row[:4])
        part = sizes >= 0
        ends = np.cumsum(sizes[part])
        if len(ends):
            raw = pa.decompress(row[4].as_buffer(), int(ends[-1]), "zstd", asbytes=True)
            names = [self.strings.setdefault(raw[b - n:b], len(self.strings)) for b, n in zip(
                ends.tolist(), sizes[part].tolist(), strict=True)]
            for column, values in zip(self.members, (ids[part], fps[part], ats[part], np.array(names, np.int64)), strict=True):
                column.append(values)
        if part.all():
            return None
        return _ranges(ids[~part], fps[~part], np.zeros(int((~part).sum()), np.int64), ats[~part])

    def ranges(self) -> Iterator[pa.RecordBatch]:
        if not self.strings:
            return
        ids, fps, ats, which = (np.concatenate(c) for c in self.members)
        strings = list(self.strings)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        low = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(low, which, ids)
        # Strings of one anchor (the smallest of their grams); alone with it a string repeats as a whole or not at all.
        begins = np.cumsum(sizes) - sizes
        gram = gram_of(self.width)
        grams = np.append(_gram_hashes(b"".join(strings), gram), np.zeros(gram - 1, np.uint64))
        grams[(begins[1:, None] - np.arange(1, gram)).ravel()] = np.iinfo(np.uint64).max
        grams[-(gram - 1):] = np.iinfo(np.uint64).max
        _, anchor, count = np.unique(np.minimum.reduceat(grams, begins), return_inverse=True, return_counts=True)
        alone = count[anchor] == 1
        # Runs of windows of a string with one smallest id: (string, first window, end, id).
        run = np.flatnonzero(alone)
        runs = [(run, np.zeros(len(run), np.int64), sizes[run] - self.width + 1, low[run])]
        several = np.flatnonzero(~alone)
        if len(several):
            runs.extend(self._several(several, [strings[k] for k in several.tolist()], sizes[several], low[several], anchor[several]))
        owner, first, end, least = (np.concatenate(c) for c in zip(*runs, strict=True))
        order = np.lexsort((first, owner))
        owner, first, end, least = owner[order], first[order], end[order], least[order]
        cuts = np.searchsorted(owner, np.arange(len(strings) + 1))
        many = np.diff(cuts)[which]
        member = np.repeat(np.arange(len(which)), many)
        at = np.repeat(cuts[which] - (np.cumsum(many) - many), many) + np.arange(len(member))
        hit = least[at] < ids[member]
        member, at = member[hit], at[hit]
        if len(member):
            yield _ranges(ids[member], fps[member], ats[member] + first[at], ats[member] + end[at] + self.width - 1)

    def _several(self, names: np.ndarray, strings: list[bytes], sizes: np.ndarray, low: np.ndarray,
                 anchor: np.ndarray) -> Iterator[tuple]:
        """Runs of the different strings of anchors.

        A window whose hash occurs once is in one string only.  The runs of the others are the pieces to sort; many
        strings around one passage have few different ones, and a piece that is alone with its anchor needs no order."""
        whole = b"".join(strings)
        begins, many = np.cumsum(sizes) - sizes, sizes - self.width + 1
        owner = np.repeat(np.arange(len(names)), many)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        hashes = _gram_hashes(whole, self.width)[begins[owner] + step]
        order = np.argsort(hashes)
        same = hashes[order[1:]] == hashes[order[:-1]]
        again = np.empty(len(order), bool)
        again[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (again[1:] != again[:-1])]))
        first, end = step[new], step[np.append(new[1:], len(owner)) - 1] + 1
        owner, again = owner[new], again[new]
        yield names[owner[~again]], first[~again], end[~again], low[owner[~again]]
        owner, first, end = owner[again], first[again], end[again]
        at = begins[owner] + first
        numbers: dict[bytes, int] = {}
        piece = np.array([numbers.setdefault(whole[a:b], len(numbers)) for a, b in zip(
            at.tolist(), (at + (end - first) + self.width - 1).tolist(), strict=True)], np.int64)
        least, group = np.full(len(numbers), np.iinfo(np.int64).max), np.empty(len(numbers), np.int64)
        np.minimum.at(least, piece, low[owner])
        group[piece] = anchor[owner]
        rest = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1)
        sole = np.ones(len(numbers), bool)
        sole[rest] = False
        sole = sole[piece]
        yield names[owner[sole]], first[sole], end[sole], least[piece[sole]]
        if len(rest):
            pieces = list(numbers)
            pieces = [pieces[k] for k in rest.tolist()]
            found, start, stop, value = self._runs(rest, pieces, np.fromiter(map(len, pieces), np.int64, len(pieces)), least[rest])
            owner, first, piece = owner[~sole], first[~sole], piece[~sole]
            begin = np.searchsorted(found, piece)
            many = np.searchsorted(found, piece, side="right") - begin
            place = np.repeat(np.arange(len(piece)), many)
            at = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(len(place))
            yield names[owner[place]], first[place] + start[at], first[place] + stop[at], value[at]

    def _runs(self, names: np.ndarray, strings: list[bytes], sizes: np.ndarray, low: np.ndarray) -> tuple:
        least, begins = _covered(strings, low, self.width, None)
        many = sizes - self.width + 1
        owner = np.repeat(np.arange(len(names)), many)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        value = least[begins[owner] + step]
        new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])]))
        last = np.append(new[1:], len(owner)) - 1
        return names[owner[new]], step[new], step[last] + 1, value[new]


def _ranges(ids, fps, starts, stops) -> pa.RecordBatch:
    """Ranges of one row united where they touch, as far as this call sees them."""
    order = np.lexsort((starts, fps, ids))
    ids, fps, starts, stops = ids[order], fps[order], starts[order].astype(np.int64), stops[order].astype(np.int64)
    row = np.cumsum(np.concatenate([[0], (ids[1:] != ids[:-1]) | (fps[1:] != fps[:-1])]))
    # The furthest stop so far within a row, by one running maximum over (row, stop).
    span = int(stops.max()) + 1
    reach = np.maximum.accumulate(row * span + stops) - row * span
    fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (starts[1:] > reach[:-1])])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(fresh)) - 1
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[first], fps[first], starts[first], reach[last])],
                                      names=["id", "fp", "start", "stop"])


def remove_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, spans (start, stop), kept (the bytes that stay)."""
    if width < GRAM:
        raise ValueError(f"strings of {GRAM} bytes at least")
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"))
    # Only where an id has several texts must its rows be told apart by a fingerprint.
    fp = F.xxhash64(F.coalesce("text", F.lit("")))
    again = rows.groupBy("id").agg(F.min(fp).alias("a"), F.max(fp).alias("b")).where("a <> b")
    rows = rows.withColumn("fp", F.lit(0).cast("long") if again.isEmpty() else fp)
    named = rows.where(F.col("id").isNotNull() & F.col("text").isNotNull())
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 << max(0, math.ceil(math.log2(max(1, size / SHARD_BYTES))))
    bits = min(MOST_BITS, max(16, shards.bit_length() + 2, math.ceil(math.log2(max(1, size)) - 2)))
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / TASK_BYTES)))
    bitmap = spark.sparkContext.broadcast(repeated_anchors(named.select("text"), width, shards, bits, tasks))
    ranges = repeated_ranges(repeated_stretches(named, bitmap, width, shards, bits), width, tasks)
    spans = stored(ranges, "suffix-ranges").groupBy("id", "fp").agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("ranges"))
    keyed = rows.withColumn("key", id_key("id"))
    found = spans.select(id_key("id").alias("key"), F.col("fp"), "ranges")
    joined = keyed.join(found, ["key", "fp"], "left").select(
        "text", "id", F.transform("ranges", lambda r: r.start).alias("start"), F.transform("ranges", lambda r: r.stop).alias("stop"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 0):
                out: list[list] = [[], [], [], [], []]
                for text, starts, stops in zip(part.column(0).to_pylist(), part.column(2).to_pylist(),
                                               part.column(3).to_pylist(), strict=True):
                    raw = (text or "").encode("utf-8")
                    spans: list[list[int]] = []
                    for a, b in zip(starts or (), stops or ()):
                        if spans and a <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], b)
                        else:
                            spans.append([a, b])
                    edges = [0, *(x for s in spans for x in s), len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    for column, value in zip(out, (len(raw), len(raw) - len(kept), len(spans),
                                                   [{"start": a, "stop": b} for a, b in spans], kept), strict=True):
                        column.append(value)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], kind), pa.array(out[4], pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return joined.mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, "
                                  "spans array<struct<start:bigint,stop:bigint>>, kept binary")
