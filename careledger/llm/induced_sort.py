"""External induced suffix sorting with common-prefix values.

The suffixes of a byte text are sorted by induction: the order of the leftmost
S-type (LMS) suffixes gives, in one scan upwards, the order of all L-type
suffixes, and those in one scan downwards the order of all S-type suffixes.  The
scans run over a monotone priority queue: one first-in-first-out run per first
symbol, whose tuples (position, common prefix with the tuple before) wait in
memory up to a budget and on disk beyond it.  The text may be a memory map; types,
names of LMS substrings and their positions are arrays in memory.  The common prefix of two induced suffixes is one more than the smallest
value between the suffixes that they were induced from.

LMS suffixes are ordered by recursion: LMS substrings get names, and the text of
names is sorted by doubling up to the depth that decides ``depth`` symbols.
Suffixes that agree on ``depth`` symbols may stand in any order, and common
prefixes count up to ``depth``.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20             # tuples that are worked on at a time


class Run:
    """Tuples (position, prefix) in order; its oldest part may lie on disk."""

    def __init__(self, folder: str):
        self.folder, self.file, self.stored = folder, None, 0
        self.held: list[np.ndarray] = []

    def append(self, block: np.ndarray) -> None:
        self.held.append(block)

    def spill(self) -> int:
        """Move what is held to disk; returns the number of tuples moved."""
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=self.folder)
        self.file.seek(0, 2)
        moved = sum(map(len, self.held))
        for block in self.held:
            block.tofile(self.file)
        self.stored, self.held = self.stored + moved, []
        return moved

    def _stored(self, at: int, count: int) -> np.ndarray:
        self.file.seek(at * TUPLE.itemsize)
        return np.fromfile(self.file, TUPLE, count)

    def drain(self) -> Iterator[np.ndarray]:
        """All tuples in order, also those that arrive meanwhile."""
        done = 0
        while done < self.stored or self.held:
            if done < self.stored:
                block = self._stored(done, min(BLOCK, self.stored - done))
                done += len(block)
            else:
                waiting, self.held = self.held, []
                block = np.concatenate(waiting)
            for a in range(0, len(block), BLOCK):
                yield block[a:a + BLOCK]

    def blocks(self, backwards: bool = False) -> Iterator[np.ndarray]:
        cuts = list(range(0, self.stored, BLOCK))
        if backwards:
            for block in reversed(self.held):
                yield block[::-1]
            for at in reversed(cuts):
                yield self._stored(at, min(BLOCK, self.stored - at))[::-1]
        else:
            for at in cuts:
                yield self._stored(at, min(BLOCK, self.stored - at))
            yield from self.held

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.file, self.held, self.stored = None, [], 0


TUPLE = np.dtype([("at", np.int32), ("prefix", np.int32)])


class Queue:
    """One run per symbol; what waits in memory stays below ``budget`` tuples."""

    def __init__(self, symbols: int, folder: str, budget: int):
        self.runs = [Run(folder) for _ in range(symbols)]
        self.budget, self.waiting = budget, 0

    def push(self, symbol: int, block: np.ndarray) -> None:
        self.runs[symbol].append(block)
        self.waiting += len(block)
        if self.waiting > self.budget:
            for run in self.runs:
                run.spill()
            self.waiting = 0

    def close(self) -> None:
        for run in self.runs:
            run.close()


def _types(text: np.ndarray) -> np.ndarray:
    """True for S-type positions; the last symbol, a unique smallest one, is S-type."""
    step = np.sign(np.diff(text.astype(np.int16)))
    at = np.where(step != 0, np.arange(len(step), dtype=np.int32), np.int32(len(step)))
    at = np.minimum.accumulate(at[::-1])[::-1]
    small = np.ones(len(text), bool)
    small[:-1] = step[np.minimum(at, len(step) - 1)] > 0
    return small


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Symbols on which the suffixes at ``a`` and ``b`` agree, up to ``depth``."""
    out = np.zeros(len(a), np.int32)
    live = np.arange(len(a))
    for k in range(depth):
        x, y = a[live] + k, b[live] + k
        inside = (x < len(text)) & (y < len(text))
        live, x, y = live[inside], x[inside], y[inside]
        live = live[text[x] == text[y]]
        if not len(live):
            break
        out[live] = k + 1
    return out


def _refine(names: np.ndarray, live: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Split the groups of equal names among ``live`` by ``keys``; returns what is still in a group.

    A group's name is the number of names smaller than it, so groups split in place."""
    group = names[live]
    order = np.lexsort((keys, group)) if keys.max() >= 1 << 31 else np.argsort(group << 32 | keys)
    g, v = group[order], keys[order]
    start = np.concatenate([[True], g[1:] != g[:-1]])
    new = start | np.concatenate([[True], v[1:] != v[:-1]])
    number = np.arange(len(g))
    names[live[order]] = g + np.maximum.accumulate(np.where(new, number, 0)) - np.maximum.accumulate(
        np.where(start, number, 0))
    size = np.diff(np.append(np.flatnonzero(new), len(g)))
    return np.sort(live[order[np.repeat(size > 1, size)]])


def _lms_order(text: np.ndarray, small: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """The LMS positions in the order of their suffixes (to ``depth`` symbols)."""
    ends = np.append(lms[1:], len(text) - 1)                 # an LMS substring ends at the next LMS position
    names = np.zeros(len(lms), np.int64)
    live, k = np.arange(len(lms)), 0
    while len(live):
        key = np.zeros(len(live), np.int64)
        for j in range(6):                                   # six symbols with their types in one word
            at = np.minimum(lms[live] + k + j, len(text) - 1)
            symbol = (text[at].astype(np.int64) * 2 + small[at]) + 1
            key = key * 1024 + np.where(lms[live] + k + j <= ends[live], symbol, 0)
        k += 6
        live = _refine(names, live, key)
        live = live[lms[live] + k <= ends[live]]
    # The text of names: doubling until names are unique or decide ``depth`` symbols (a name spans two at least).
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    live, span = np.sort(order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]), 1
    while len(live) and span * 2 < depth + 2:
        follow = np.where(live + span < len(names), names[np.minimum(live + span, len(names) - 1)] + 1, 0)
        live = _refine(names, live, follow)
        span *= 2
    return lms[np.argsort(names, kind="stable")]


def sorted_suffixes(text: np.ndarray, depth: int, folder: str | None = None,
                    budget: int = 1 << 25) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (positions, common prefix with the suffix before) of all suffixes in ascending order.

    ``text``: uint16 symbols (an array or a memory map) that end in a unique smallest symbol.
    """
    symbols = int(text.max()) + 1
    if len(text) > np.iinfo(np.int32).max:
        raise ValueError("positions of a shard are 32-bit numbers: cut it into smaller ones")
    small = _types(text)
    is_lms = small.copy()
    is_lms[0] = False
    is_lms[1:] &= ~small[:-1]
    lms = np.flatnonzero(is_lms).astype(np.int32)
    lms = _lms_order(text, small, lms, depth)
    seed = np.empty(len(lms), TUPLE)
    seed["at"] = lms
    seed["prefix"][:1] = 0
    seed["prefix"][1:] = common_prefix(text, lms[:-1], lms[1:], depth)
    bucket = np.searchsorted(text[lms], np.arange(symbols + 1))
    with tempfile.TemporaryDirectory(dir=folder) as own:
        up, down = Queue(symbols, own, budget), Queue(symbols, own, budget)
        low = [Run(own) for _ in range(symbols)]              # L-type suffixes of each symbol, in order
        high = [Run(own) for _ in range(symbols)]             # S-type suffixes, descending
        try:
            since = np.full(symbols, -1, np.int32)             # no push yet: nothing in common
            for c in range(symbols):
                last = None
                for block in up.runs[c].drain():
                    _induce(text, small, block, up, since, depth, False)
                    low[c].append(block)
                    up.waiting = _room(low[c], up, len(block))
                    last = block["at"][-1:]
                block = seed[bucket[c]:bucket[c + 1]].copy()
                if len(block) and last is not None:
                    block["prefix"][0] = common_prefix(text, last, block["at"][:1], depth)[0]
                if len(block):
                    _induce(text, small, block, up, since, depth, False)
            since = np.full(symbols, -1, np.int32)             # no push yet: nothing in common
            for c in reversed(range(symbols)):
                last = None
                for block in down.runs[c].drain():
                    _induce(text, small, block, down, since, depth, True)
                    high[c].append(block)
                    down.waiting = _room(high[c], down, len(block))
                    last = block["at"][-1:]
                if c == 0:                                    # the unique end symbol starts its own bucket
                    block = np.array([(len(text) - 1, 0)], TUPLE)
                    high[c].append(block)
                    _induce(text, small, block, down, since, depth, True)
                carried = None
                for block in low[c].blocks(backwards=True):
                    # Downwards a tuple carries the prefix with the next larger suffix.
                    turned = block.copy()
                    turned["prefix"][1:] = block["prefix"][:-1]
                    turned["prefix"][0] = carried if carried is not None else (
                        common_prefix(text, last, block["at"][:1], depth)[0] if last is not None else 0)
                    carried = block["prefix"][-1]
                    _induce(text, small, turned, down, since, depth, True)
            for c in range(symbols):
                last = None
                for block in low[c].blocks():
                    yield block["at"], block["prefix"]
                    last = block["at"][-1:]
                held = None
                for block in high[c].blocks(backwards=True):
                    # Ascending again: the prefix with the suffix before is the one that the smaller suffix carries.
                    turned = block["prefix"].copy()
                    ups = np.empty(len(block), np.int32)
                    ups[1:] = turned[:-1]
                    ups[0] = held if held is not None else (
                        common_prefix(text, last, block["at"][:1], depth)[0] if last is not None else 0)
                    held = turned[-1]
                    yield block["at"], ups
        finally:
            for run in (*low, *high):
                run.close()
            up.close()
            down.close()


def _room(run: Run, queue: Queue, added: int) -> int:
    """Sorted output waits on disk like the queue does once there is more of it than the budget."""
    if sum(map(len, run.held)) > queue.budget // 8:
        run.spill()
    return max(0, queue.waiting - added)


def _induce(text: np.ndarray, small: np.ndarray, block: np.ndarray, queue: Queue, since: np.ndarray, depth: int,
            downwards: bool) -> None:
    """Push the suffixes one symbol to the left of ``block`` that are of the scan's type, in order.

    ``since[p]`` is the smallest prefix value seen after the last push to symbol p."""
    prefix = block["prefix"]
    before = block["at"] - 1
    ok = np.flatnonzero(before >= 0)
    ok = ok[small[before[ok]] == downwards]
    lowest = int(prefix.min())
    if len(ok):
        left = text[before[ok]]
        order = np.argsort(left, kind="stable")
        ok, left = ok[order], left[order]
        cuts = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1], [True]]))
        firsts = {}
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            p, members = int(left[a]), ok[a:b]
            out = np.empty(b - a, TUPLE)
            out["at"] = before[members]
            values = np.minimum.reduceat(prefix, np.concatenate([[0], members + 1])[:-1 if members[-1] + 1 >= len(prefix) else None])
            out["prefix"] = np.minimum(values[:b - a] + 1, depth)
            out["prefix"][0] = min(min(int(since[p]), int(values[0])) + 1, depth)
            firsts[p] = (out, int(values[b - a]) if len(values) > b - a else depth)
        np.minimum(since, lowest, out=since)
        for p, (out, rest) in firsts.items():
            since[p] = rest
            queue.push(p, out)
    else:
        np.minimum(since, lowest, out=since)
