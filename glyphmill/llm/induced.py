"""External induced sorting of the suffixes of a text, with their common prefixes, in bounded memory.

Suffixes are sorted by induction: those at local minima first, from them all that are larger than their successor
(scanned upwards), and from these all that are smaller (downwards). The queue of pending suffixes is a priority
queue whose priority is the first symbol: a suffix is only ever pushed at or beyond the symbol being scanned, so
first-in-first-out lists for each symbol, spilled to disk beyond ``memory`` entries, give the exact order. Each
tuple (position, common prefix with the one before) carries its common prefix: that of two suffixes pushed one after
the other is one more than the least among those scanned between them.

The local minima are ordered by names of the substrings between them, themselves found by one induction: the
string of names is sorted recursively while it has few names, and by doubling beyond. Depths beyond ``cap`` symbols
aren't told apart: common prefixes are cut off there, which is all that repeats of that length need.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Entries that a queue keeps in memory, rows scanned at once, and the most names for which recursion goes on.
MEMORY, CHUNK, NAMES = 1 << 20, 1 << 16, 1024
FAR = np.int16(32000)
ENTRY = np.dtype([("pos", np.int64), ("lcp", np.int16)])
NONE = np.zeros(0, ENTRY)


class BucketQueue:
    """First-in-first-out lists by symbol; the entries in memory go to a file when there are too many."""

    def __init__(self, symbols: int, memory: int = MEMORY):
        self.lists: list[list] = [[] for _ in range(symbols)]  # arrays, or (offset, count) in the file
        self.memory, self.held, self.file = memory, 0, None

    def push(self, symbol: int, entries: np.ndarray) -> None:
        self.lists[symbol].append(entries)
        self.held += len(entries)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for chunks in self.lists:
            for k, c in enumerate(chunks):
                if isinstance(c, np.ndarray):
                    chunks[k] = (self.file.tell(), len(c))
                    self.file.write(c.tobytes())
        self.held = 0

    def pop(self, symbol: int) -> np.ndarray:
        chunks, self.lists[symbol] = self.lists[symbol], []
        out = []
        for c in chunks:
            if isinstance(c, tuple):
                self.file.seek(c[0])
                c = np.frombuffer(self.file.read(c[1] * ENTRY.itemsize), ENTRY)
            else:
                self.held -= len(c)
            out.append(c)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else NONE

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _entries(pos: np.ndarray, lcp: np.ndarray | int) -> np.ndarray:
    out = np.empty(len(pos), ENTRY)
    out["pos"], out["lcp"] = pos, lcp
    return out


class _Scan:
    """Pushes the predecessors of scanned suffixes, of one type, with their common prefixes."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, queue: BucketQueue, symbols: int, cap: int):
        self.text, self.wanted, self.queue, self.cap = text, wanted, queue, cap
        self.since = np.full(symbols, -1, np.int16)  # the least common prefix scanned since a symbol's last push; -1: none yet

    def feed(self, batch: np.ndarray) -> None:
        for at in range(0, len(batch), CHUNK):
            self._feed(batch[at : at + CHUNK])

    def _feed(self, batch: np.ndarray) -> None:
        pos, lcp = batch["pos"], np.ascontiguousarray(batch["lcp"])
        least = np.minimum.accumulate(lcp)
        row = np.flatnonzero((pos > 0) & self.wanted[pos - 1])
        if not len(row):
            np.minimum(self.since, least[-1], out=self.since)
            return
        symbol = self.text[pos[row] - 1]
        order = np.argsort(symbol, kind="stable")
        row, symbol = row[order], symbol[order]
        first = np.concatenate(([True], symbol[1:] != symbol[:-1]))
        begin = np.flatnonzero(first)
        value = np.empty(len(row), np.int16)
        value[begin] = np.minimum(self.since[symbol[begin]], least[row[begin]])
        later = np.flatnonzero(~first)
        if len(later):
            value[later] = _range_least(lcp, row[later - 1] + 1, row[later])
        out = _entries(pos[row] - 1, np.minimum(value + np.int16(1), self.cap))
        np.minimum(self.since, least[-1], out=self.since)
        end = np.append(begin[1:], len(row))
        rest = np.append(np.minimum.accumulate(lcp[::-1])[::-1], FAR)
        self.since[symbol[begin]] = rest[row[end - 1] + 1]
        for s, x, y in zip(symbol[begin].tolist(), begin.tolist(), end.tolist(), strict=True):
            self.queue.push(s, out[x:y])


def _range_least(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of x[low..high], by minima of power-of-two lengths."""
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    table = [x]
    for k in range(int(level.max())):
        last, half = table[-1], 1 << k
        table.append(np.minimum(last, np.append(last[half:], np.full(min(half, len(x)), FAR, x.dtype))))
    out = np.empty(len(low), x.dtype)
    for k in range(len(table)):
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[k][low[at]], table[k][high[at] - (1 << k) + 1])
    return out


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are smaller than their successor (the last one is), and each position's run of equal symbols."""
    n = len(text)
    change = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1).astype(np.int32 if n < 2**31 else np.int64)
    stop = np.repeat(change, np.diff(np.concatenate(([-1], change))))  # the last position of each run
    small = np.ones(n, bool)
    inner = stop < n - 1
    small[inner] = text[stop[inner]] < text[stop[inner] + 1]
    return small, stop


def _induce(text: np.ndarray, symbols: int, small: np.ndarray, stop: np.ndarray, seeds: np.ndarray, cap: int, memory: int) -> Iterator[np.ndarray]:
    """All suffixes from the largest to the smallest, in batches; lcp is that with the one given before.

    seeds: the suffixes at local minima in ascending order, lcp that with the seed before.
    """
    n = len(text)

    def seam(a: int, b: int) -> int:
        return min(int(stop[a]) - a, int(stop[b]) - b, cap - 1) + 1  # runs of one symbol, then a smaller and a larger one

    up, larger, down = BucketQueue(symbols, memory), BucketQueue(symbols, memory), BucketQueue(symbols, memory)
    try:
        scan = _Scan(text, ~small, up, symbols, cap)
        of = text[seeds["pos"]]
        bounds = np.searchsorted(of, np.arange(symbols + 1))
        for c in range(symbols):
            last = -1
            while len(batch := up.pop(c)):
                larger.push(c, batch)
                scan.feed(batch)
                last = int(batch["pos"][-1])
            if len(own := seeds[bounds[c] : bounds[c + 1]]):
                own = own.copy()
                own["lcp"][0] = seam(last, int(own["pos"][0])) if last >= 0 else 0
                scan.feed(own)
        scan = _Scan(text, small, down, symbols, cap)
        for c in reversed(range(symbols)):
            last = -1
            if c == text[n - 1]:
                down.push(c, _entries(np.array([n - 1]), 0))
            while len(batch := down.pop(c)):
                yield batch
                scan.feed(batch)
                last = int(batch["pos"][-1])
            if len(part := larger.pop(c)):
                back = _entries(part["pos"][::-1], np.append(np.int16(0), part["lcp"][:0:-1]))
                back["lcp"][0] = seam(last, int(back["pos"][0])) if last >= 0 else 0
                yield back
                scan.feed(back)
    finally:
        for q in (up, larger, down):
            q.close()


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes at a and at b, at most cap."""
    step = 4
    padded = np.concatenate((text.astype(np.uint16), np.zeros(cap + 2 * step, np.uint16)))
    wide = [padded[k : k + (len(padded) - k) // step * step].view(np.uint64) for k in range(step)]
    word = lambda at: np.choose(at % step, [w[np.minimum(at // step, len(w) - 1)] for w in wide])
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for done in range(0, cap, step):
        x, y = a[live] + done, b[live] + done
        fine = (np.maximum(x, y) < len(text))
        live, x, y = live[fine], x[fine], y[fine]
        same = word(x) == word(y)
        stops = live[~same]
        for k in range(step):  # within the word that differs
            i, j = a[stops] + done + k, b[stops] + done + k
            go = padded[i] == padded[j]
            stops = stops[go]
            out[stops] = done + k + 1
        live = live[same]
        out[live] = done + step
        if not len(live):
            break
    return np.minimum(out, cap)


def _ranks(names: np.ndarray, count: int, depth: int, memory: int) -> np.ndarray:
    """The order of the suffixes of a string of names, told apart at least to ``depth`` names."""
    m = len(names)
    if count == m:
        order = np.empty(m, np.int64)
        order[names] = np.arange(m)
        return order
    if count <= NAMES and m > 4 * NAMES:
        return suffixes(names + 1, count + 1, min(depth, 30000), memory)[::-1]
    rank, h = names.astype(np.int64), 1
    while True:
        after = np.zeros(m, np.int64)
        if h < m:
            after[: m - h] = rank[h:] + 1
        key = rank * (m + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty(m, np.int64)
        rank[order] = new
        h *= 2
        if new[-1] == m - 1 or h >= depth:
            return order


def _minima(text: np.ndarray, symbols: int, cap: int, memory: int, small: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The suffixes at local minima in ascending order."""
    at = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(at) == 1:
        return at
    is_minimum = np.zeros(len(text), bool)
    is_minimum[at] = True
    first = np.argsort(text[at], kind="stable")
    rough = _induce(text, symbols, small, stop, _entries(at[first], 0), cap, memory)
    order = np.concatenate([b["pos"][is_minimum[b["pos"]]] for b in rough])[::-1]
    # names: equal neighbours have equal symbols from minimum to minimum
    kind = np.int32 if len(text) < 2**31 else np.int64
    size = np.zeros(len(text), kind)
    size[at] = np.append(np.diff(at), 0) + 1
    same = (size[order[1:]] == size[order[:-1]]) & (_common(text, order[1:], order[:-1], min(cap, int(size.max()))) >= np.minimum(size[order[1:]], cap))
    name = np.empty(len(text), kind)
    name[order] = np.concatenate(([0], np.cumsum(~same)))
    names = name[at].astype(np.int64)
    del size, name, is_minimum
    return at[_ranks(names, int(names.max()) + 1, cap, memory)]


def _sorted(text: np.ndarray, symbols: int, cap: int, memory: int) -> Iterator[np.ndarray]:
    small, stop = _types(text)
    at = _minima(text, symbols, cap, memory, small, stop)
    lcp = np.zeros(len(at), np.int16)
    if len(at) > 1:
        lcp[1:] = _common(text, at[1:], at[:-1], cap)
    return _induce(text, symbols, small, stop, _entries(at, lcp), cap, memory)


def suffixes(body: np.ndarray, symbols: int, cap: int, memory: int = MEMORY) -> np.ndarray:
    """The suffixes of ``body`` (symbols from 1), from the largest to the smallest, told apart to ``cap`` symbols."""
    text = np.append(body.astype(np.int64), 0)
    out = np.concatenate([b["pos"] for b in _sorted(text, symbols, cap, memory)])
    return out[out < len(body)]


def repeated_starts(texts: list[bytes], length: int, memory: int = MEMORY) -> list[np.ndarray]:
    """For each text, its positions where a string of ``length`` bytes starts that starts anywhere else in ``texts`` too."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    body = np.frombuffer(b"\0".join(texts), np.uint8).astype(np.uint16) + 2
    begins = np.concatenate(([0], np.cumsum(sizes[:-1] + 1))) if len(texts) else np.zeros(0, np.int64)
    body[begins[1:] - 1] = 1  # what divides two texts
    twice = np.zeros(len(body) + 1, bool)
    before = -1
    for b in _sorted(np.append(body, np.uint16(0)), 258, length, memory):
        pos = np.append(before, b["pos"])
        at = np.flatnonzero(b["lcp"] >= length)
        twice[pos[at]] = True
        twice[pos[at + 1]] = True
        before = int(b["pos"][-1])
    # a window that reaches a divider is none
    return [np.flatnonzero(twice[x : x + n - length + 1]) if n >= length else np.zeros(0, np.int64) for x, n in zip(begins.tolist(), sizes.tolist(), strict=True)]
