"""Suffix array with common-prefix lengths by external induced sorting.

The leftmost S-type suffixes (those after an L-type one) are ranked first: their substrings are sorted by
induction and named, and the string of names is ranked in turn by doubling. Then all other suffixes are
induced from them: a scan in order pushes the suffix one place to the left of each into the queue of its first
byte. Tuples (place, common prefix with the tuple before it in its queue) wait in one queue for each byte.
The common prefix of two neighbours in a queue is one more than the least on the way from one source to
the other. Queues hold arrays; beyond a budget these go to files, as do the arrays over the whole text, so
that memory does not grow with the shard. The scan takes as much of a queue at a time as its own pushes allow:
what it pushes into the queue it reads makes the next wave.

Strings are sequences of letters from 1 to LETTERS - 1. Several are sorted at once; each is closed by a 0, which
counts as an end of its own, smaller than any letter and different from all other ends.
"""

from __future__ import annotations

import os
import tempfile
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np

from roadpulse.llm import hashing

#: Bytes of queues and of arrays over the text that stay in memory.
BUDGET = 128_000_000
#: Tuples that a step of the scan takes at a time.
WAVE = 1 << 18
_FAR = np.int32(2**31 - 1)
#: Bytes are the letters from 1 to 256; one more is free for a mark.
LETTERS = 258
_VALUES = hashing.mix(np.arange(1, LETTERS + 1, dtype=np.uint64) * np.uint64(hashing.BASE))


class _Store:
    """What stays in memory up to a budget; beyond it, queues go to a file each, arrays over the text to one each."""

    def __init__(self, folder: str, budget: int):
        self.folder, self.left, self.files = folder, budget, 0
        self.queues: list[_Queue] = []

    def path(self) -> str:
        self.files += 1
        return os.path.join(self.folder, str(self.files))

    def keep(self, values: np.ndarray) -> np.ndarray:
        if values.nbytes <= self.left or not len(values):
            self.left -= values.nbytes
            return values
        path = self.path()
        values.tofile(path)
        return np.memmap(path, values.dtype, "r", shape=values.shape)

    def took(self, size: int) -> None:
        """A queue holds so much more; over the budget, the largest ones give way."""
        self.left -= size
        while self.left < 0:
            largest = max(self.queues, key=lambda q: q.held)
            if not largest.held:
                break
            largest.spill()


class _Queue:
    """Tuples (place, common prefix) in the order they came: the older ones in a file, which is open only while it is
    read or added to, the newer ones in memory."""

    def __init__(self, store: _Store):
        self.store, self.path, self.filed = store, None, 0
        self.chunks: list[np.ndarray] = []
        self.ends = [0]  # of the chunks, counted from the first in memory
        self.held = 0  # bytes in memory
        store.queues.append(self)

    @property
    def size(self) -> int:
        return self.filed + self.ends[-1]

    def push(self, place: np.ndarray, common: np.ndarray) -> None:
        chunk = np.stack([place, common], axis=1).astype(np.int32)
        self.chunks.append(chunk)
        self.ends.append(self.ends[-1] + len(chunk))
        self.held += chunk.nbytes
        self.store.took(chunk.nbytes)

    def spill(self) -> None:
        self.path = self.path or self.store.path()
        with open(self.path, "ab") as out:
            for chunk in self.chunks:
                out.write(chunk.tobytes())
        self.filed += self.ends[-1]
        self.store.left += self.held
        self.chunks, self.ends, self.held = [], [0], 0

    def _read(self, start: int, stop: int) -> np.ndarray:
        cut = []
        if start < self.filed:
            many = min(stop, self.filed) - start
            cut.append(np.fromfile(self.path, np.int32, 2 * many, offset=8 * start).reshape(-1, 2))
        low, high = max(start - self.filed, 0), stop - self.filed
        at = bisect_right(self.ends, low) - 1
        while low < high:
            chunk = self.chunks[at][low - self.ends[at] : high - self.ends[at]]
            cut.append(chunk)
            low, at = low + len(chunk), at + 1
        return np.concatenate(cut)

    def waves(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Also what is pushed meanwhile."""
        at = 0
        while at < self.size:
            wave = self._read(at, min(at + WAVE, self.size))
            at += len(wave)
            yield wave[:, 0].copy(), wave[:, 1].copy()

    def backwards(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for stop in range(self.size, 0, -WAVE):
            wave = self._read(max(0, stop - WAVE), stop)[::-1]
            yield wave[:, 0].copy(), wave[:, 1].copy()

    def last(self) -> int | None:
        return int(self._read(self.size - 1, self.size)[0, 0]) if self.size else None

    def close(self) -> None:
        if self.path is not None:
            os.unlink(self.path)
        self.store.left += self.held
        self.store.queues.remove(self)
        self.chunks, self.ends, self.held, self.filed, self.path = [], [0], 0, 0, None


def _range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low:high + 1], each range not empty."""
    levels = [values]
    widest = int((high - low).max(initial=0)) + 1
    while 1 << len(levels) <= widest:
        half, step = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(half[:-step], half[step:]))
    level = np.zeros(len(low), np.int64)
    for k in range(1, len(levels)):
        level[high - low + 1 >= 1 << k] = k
    out = np.empty(len(low), values.dtype)
    for k, row in enumerate(levels):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k) + 1])
    return out


class _Scan:
    """Pushes what each scanned suffix induces, with common prefixes from source to source."""

    def __init__(self, letters: np.ndarray, store: _Store, track: bool):
        self.letters, self.track = letters, track
        self.queues = [_Queue(store) for _ in range(LETTERS)]
        self.least = np.full(LETTERS, _FAR, np.int32)
        self.begun = np.zeros(LETTERS, bool)

    def step(self, place: np.ndarray, common: np.ndarray, wanted: np.ndarray) -> None:
        """``common`` is with the suffix scanned before; ``wanted`` tells which places precede to be pushed."""
        source = np.flatnonzero(wanted)
        left = place[source] - 1
        target = self.letters[left]
        order = np.argsort(target, kind="stable")
        source, left, target = source[order], left[order], target[order]
        if not len(source):
            self.least = np.minimum(self.least, common.min(initial=_FAR))
            return
        head = np.ones(len(source), bool)
        head[1:] = target[1:] != target[:-1]
        starts = np.append(np.flatnonzero(head), len(source))
        if not self.track:
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                self.queues[target[a]].push(left[a:b], common[:1].repeat(b - a))
            return
        before = np.empty(len(source), np.int64)
        before[1:] = source[:-1] + 1
        before[head] = 0
        tail = np.append(np.minimum.accumulate(common[::-1])[::-1], _FAR)
        between = _range_minima(common, before, source)
        between[head] = np.minimum(between[head], self.least[target[head]])
        found = np.minimum(between, _FAR - 1) + 1
        found[head & ~self.begun[target]] = 0
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            self.queues[target[a]].push(left[a:b], found[a:b])
        self.least = np.minimum(self.least, tail[0])
        last = starts[1:] - 1
        self.least[target[last]] = tail[source[last] + 1]
        self.begun[target[last]] = True


class Suffixes:
    """All suffixes of several strings, in order, with common prefixes."""

    def __init__(self, letters: np.ndarray, folder: str, budget: int = BUDGET):
        """``letters`` holds the strings one after the other, none empty, each closed by a 0."""
        self.store = _Store(folder, budget)
        keep = self.store.keep
        ends = np.flatnonzero(letters == 0)
        letters = letters.astype(np.int16)
        self.letters = keep(letters)
        n = len(letters)
        change = np.append(np.flatnonzero(np.diff(letters)), n - 1)
        run = change[np.searchsorted(change, np.arange(n))] + 1
        self.run = keep((run - np.arange(n)).astype(np.int32))
        after = letters[np.minimum(run, n - 1)]
        small = (after > letters) | (letters == 0)
        self.small = keep(small)
        self.first = np.flatnonzero(small[1:] & ~small[:-1]) + 1
        self.running = keep(hashing.running_hash(letters, _VALUES))
        self.room = keep((ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)).astype(np.int32))

    def _induce(self, seeds: np.ndarray, common: np.ndarray | None) -> tuple[_Scan, _Scan]:
        """Queues of the L-type suffixes and of the S-type ones (these from the largest down). Without
        common prefixes of the seeds, none are carried."""
        letters, small = self.letters, self.small
        track = common is not None
        common = np.zeros(len(seeds), np.int32) if common is None else common
        up = _Scan(letters, self.store, track)
        bounds = np.searchsorted(letters[seeds], np.arange(LETTERS + 1))
        for c in range(LETTERS):
            queue = up.queues[c]
            for place, least in queue.waves():
                up.step(place, least, (place > 0) & ~small[place - 1])
            place, least = seeds[bounds[c] : bounds[c + 1]], common[bounds[c] : bounds[c + 1]].copy()
            if len(place):
                last = queue.last()
                least[0] = 0 if last is None else min(self.run[last], self.run[place[0]])
                for at in range(0, len(place), WAVE):
                    part = place[at : at + WAVE]
                    up.step(part, least[at : at + WAVE], (part > 0) & ~small[part - 1])
        down = _Scan(letters, self.store, track)
        for c in range(LETTERS - 1, 0, -1):
            queue = down.queues[c]
            for place, least in queue.waves():
                down.step(place, least, (place > 0) & small[place - 1] & (letters[place - 1] > 0))
            seam = queue.last()
            # Reversed, a tuple's common prefix belongs to the one after it.
            carried = None
            for place, least in up.queues[c].backwards():
                if carried is None:
                    carried = 0 if seam is None else min(self.run[place[0]], self.run[seam])
                shifted = np.append(np.int32(carried), least[:-1]).astype(np.int32)
                carried = least[-1]
                down.step(place, shifted, (place > 0) & small[place - 1] & (letters[place - 1] > 0))
        return up, down

    def _close(self, *scans: _Scan) -> None:
        for scan in scans:
            for queue in scan.queues:
                queue.close()

    def _named(self) -> tuple[np.ndarray, int]:
        """Name of the substring from each first-S place to the next; equal ones share it."""
        first, letters = self.first, self.letters
        seeds = first[np.argsort(letters[first], kind="stable")].astype(np.int64)
        up, down = self._induce(seeds, None)
        is_first = np.zeros(len(letters), bool)
        is_first[first] = True
        order = [first[letters[first] == 0]]
        for c in range(1, LETTERS):
            found = [p[is_first[p]] for p, _ in down.queues[c].backwards()]
            order += found
        self._close(up, down)
        sorted_first = np.concatenate(order).astype(np.int64)
        number = np.searchsorted(first, sorted_first)
        following = np.append(first, len(letters) - 1)[number + 1]
        same = np.zeros(len(first), bool)
        # A substring that reaches an end is like no other.
        whole = (letters[sorted_first] > 0) & (letters[following] > 0)
        stop = np.where(whole, following + 1, sorted_first)
        content = hashing.range_hash(self.running, sorted_first, stop)
        same[1:] = whole[1:] & whole[:-1] & (content[1:] == content[:-1])
        names = np.empty(len(first), np.int64)
        names[number] = np.cumsum(~same) - 1
        return names, int((~same).sum())

    def _ranked(self) -> np.ndarray:
        """First-S places in the order of their suffixes."""
        rank, different = self._named()
        step = 1
        while different < len(rank):
            behind = np.append(rank[step:], np.full(min(step, len(rank)), -1))[: len(rank)]
            order = np.lexsort((behind, rank))
            new = np.ones(len(rank), bool)
            new[1:] = (np.diff(rank[order]) != 0) | (np.diff(behind[order]) != 0)
            rank = rank.copy()
            rank[order] = np.cumsum(new) - 1
            different, step = int(new.sum()), step * 2
        return self.first[np.argsort(rank)]

    def _common(self, places: np.ndarray) -> np.ndarray:
        """Common prefix of each place's suffix with that of the place before it, by halving."""
        out = np.zeros(len(places), np.int32)
        a, b = places[:-1], places[1:]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.room[a], self.room[b]).astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = hashing.range_hash(self.running, a, a + middle) == hashing.range_hash(self.running, b, b + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        out[1:] = low
        return out

    def in_order(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and common prefixes with the suffix before, in order; the ends are left out."""
        ranked = self._ranked()
        up, down = self._induce(ranked, self._common(ranked))
        for c in range(1, LETTERS):
            yield from up.queues[c].waves()
            last, carried = up.queues[c].last(), None
            for place, least in down.queues[c].backwards():
                if carried is None:
                    carried = 0 if last is None else min(self.run[last], self.run[place[0]])
                shifted = np.append(np.int32(carried), least[:-1]).astype(np.int32)
                carried = least[-1]
                yield place, shifted
        self._close(up, down)


def repeated(letters: np.ndarray, size: int, budget: int = BUDGET) -> np.ndarray:
    """Places whose ``size`` letters also start elsewhere in the strings; ascending."""
    hits, last = [np.zeros(0, np.int64)], -1
    if len(letters):
        with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
            for place, common in Suffixes(letters, folder, budget).in_order():
                far = common >= size
                hits += [place[far], np.append(last, place[:-1])[far]]
                last = place[-1]
    return np.unique(np.concatenate(hits))


def closed(strings: list[bytes]) -> np.ndarray:
    """The non-empty strings as letters."""
    data = np.frombuffer(b"".join(s + b"\0" for s in strings if s), np.uint8).astype(np.int16) + 1
    data[np.cumsum([len(s) + 1 for s in strings if s]) - 1] = 0
    return data
