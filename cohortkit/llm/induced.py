"""Suffix sorting of a shard by induction over queues on disk, with common prefixes.

The shard is a file of strings, each symbol a byte above 0, each string ended by
a 0. S*-suffixes (an ascending step after a descending one) are the seeds. Their
substrings are first sorted by induction and named; the string of names is
sorted by doubling (a depth of ``depth`` bytes holds at most depth / 2 of them);
a second induction from the sorted seeds yields all suffixes in order.

Induction is a priority queue whose priority is the first symbol and, within
it, the order of arrival: one append-only queue per symbol, kept in files but for
its newest items. Each item is a suffix with the length it shares with the item
before it. An item that makes its predecessor a suffix of the wanted kind sends
it to the predecessor's symbol; what the two share is one more than the least
value since the last item sent there. Items pass in chunks; kinds, seeds, names and
ranks are arrays over the whole text, so callers bound its size. Orders and lengths are right up to ``depth`` bytes.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np

CHUNK, HELD = 1 << 18, 16 << 20
_ITEM = np.dtype([("at", "<i8"), ("shared", "<i4")])
_FAR = np.int32(1 << 30)


class BucketQueue:
    """Append-only queues by symbol, on disk beyond the newest ``HELD`` bytes."""

    def __init__(self, folder: str, name: str):
        self.path = os.path.join(folder, name)
        self.new: dict[int, list[np.ndarray]] = defaultdict(list)
        self.stored, self.size = np.zeros(256, np.int64), np.zeros(256, np.int64)
        self.held = 0

    def append(self, symbol: int, items: np.ndarray) -> None:
        self.new[symbol].append(items)
        self.size[symbol] += len(items)
        self.held += items.nbytes
        if self.held > HELD:
            for s, parts in self.new.items():
                with open(f"{self.path}-{s}", "ab") as file:
                    for part in parts:
                        file.write(part.tobytes())
            self.stored[:] = self.size
            self.new.clear()
            self.held = 0

    def read(self, symbol: int, start: int, stop: int) -> np.ndarray:
        """Items from ``start`` to ``stop``; may be fewer, at least one."""
        stored = int(self.stored[symbol])
        if start < stored:
            return np.fromfile(f"{self.path}-{symbol}", _ITEM, min(stop, stored) - start, offset=start * _ITEM.itemsize)
        parts = self.new[symbol]
        if len(parts) > 1:
            parts[:] = [np.concatenate(parts)]
        return parts[0][start - stored : stop - stored]


class _Induction:
    """One direction of the induction: sends predecessors of a kind to their symbols' queues."""

    def __init__(self, text: np.ndarray, is_s: np.ndarray, queue: BucketQueue, want_s: bool, depth: int):
        self.text, self.is_s, self.queue, self.want_s, self.depth = text, is_s, queue, want_s, depth
        self.since = np.full(256, _FAR, np.int32)
        self.used = np.zeros(256, bool)

    def step(self, at: np.ndarray, shared: np.ndarray) -> None:
        if not len(at):
            return
        before = at - 1
        sent = np.flatnonzero((at > 0) & (self.is_s[before] == self.want_s))
        symbols = self.text[before[sent]]
        order = np.argsort(symbols, kind="stable")
        sent, symbols = sent[order], symbols[order]
        lowest = np.minimum.accumulate(shared)
        since = np.minimum(self.since, lowest[-1])
        padded = np.append(shared, _FAR)
        heads = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]])) if len(symbols) else np.zeros(0, np.int64)
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(symbols)], strict=False):
            symbol, mine = int(symbols[a]), sent[a:b]
            least = np.minimum.reduceat(padded, mine + 1)
            items = np.empty(b - a, _ITEM)
            items["at"] = before[mine]
            items["shared"][1:] = np.minimum(least[:-1] + 1, self.depth)
            first = min(int(self.since[symbol]), int(lowest[mine[0]])) + 1
            items["shared"][0] = min(first, self.depth) if self.used[symbol] else 0
            since[symbol] = least[-1]
            self.used[symbol] = True
            self.queue.append(symbol, items)
        self.since = since


def _run(text: np.ndarray, at: int, depth: int) -> int:
    """How often the symbol at ``at`` repeats from there, at most ``depth`` times."""
    part = np.asarray(text[at : at + depth])
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def induce(text, is_s, folder: str, name: str, seeds: Callable[[int], Iterator[np.ndarray]], depth: int, emit: Callable) -> None:
    """Order all suffixes from sorted seeds; ``emit(at, shared)`` gets chunks from the last suffix to the first."""
    left, right = BucketQueue(folder, f"{name}-l"), BucketQueue(folder, f"{name}-s")
    forward = _Induction(text, is_s, left, False, depth)
    for symbol in range(256):
        done, last = 0, -1
        while done < left.size[symbol]:
            items = left.read(symbol, done, min(int(left.size[symbol]), done + CHUNK)).copy()
            done += len(items)
            last = int(items["at"][-1])
            forward.step(items["at"], items["shared"])
        for items in seeds(symbol):
            items = items.copy()
            if last >= 0:
                items["shared"][0] = min(_run(text, last, depth), _run(text, int(items["at"][0]), depth))
                last = -1
            forward.step(items["at"], items["shared"])
    backward = _Induction(text, is_s, right, True, depth)
    for symbol in range(255, -1, -1):
        done, last = 0, -1
        while done < right.size[symbol]:
            items = right.read(symbol, done, min(int(right.size[symbol]), done + CHUNK)).copy()
            done += len(items)
            last = int(items["at"][-1])
            emit(items["at"], items["shared"])
            backward.step(items["at"], items["shared"])
        stop, carried = int(left.size[symbol]), None
        while stop > 0:
            start = max(0, stop - CHUNK)
            parts = []
            while start < stop:
                parts.append(left.read(symbol, start, stop))
                start += len(parts[-1])
            items = np.concatenate(parts)
            stop -= len(items)
            at = items["at"][::-1].copy()
            shared = np.empty(len(at), np.int32)
            shared[1:] = items["shared"][:0:-1]
            if carried is not None:
                shared[0] = carried
            else:
                shared[0] = min(_run(text, last, depth), _run(text, int(at[0]), depth)) if last >= 0 else 0
            carried = items["shared"][0]
            emit(at, shared)
            backward.step(at, shared)


def _words(text: np.ndarray) -> np.ndarray:
    """Every eight bytes of the text as one number, by position."""
    return np.lib.stride_tricks.as_strided(text.view(np.uint8)[:8].view("<u8"), (len(text) - 7,), (1,))


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length that the suffixes at ``a`` and ``b`` share, at most ``depth``; the text has ``depth`` + 8 bytes of padding."""
    words, out = _words(text), np.zeros(len(a), np.int32)
    active = np.arange(len(a))
    for offset in range(0, depth, 8):
        x = words[a[active] + offset] ^ words[b[active] + offset]
        differs = x != 0
        if differs.any():
            low = x[differs] & (~x[differs] + np.uint64(1))
            out[active[differs]] = offset + np.log2(low.astype(float)).astype(np.int32) // 8
            active = active[~differs]
        if not len(active):
            break
    out[active] = depth
    return np.minimum(out, depth)


def order_on_disk(keys: np.ndarray, folder: str, most: int = 1 << 24) -> np.ndarray:
    """Sorted order of keys; beyond ``most`` keys they are dealt by range into files and sorted one by one."""
    if len(keys) <= most:
        return np.argsort(keys, kind="stable")
    step = max(1, len(keys) // 65_536)
    sample = np.sort(keys[::step])
    cuts = np.unique(sample[:: max(1, len(sample) * most // (4 * len(keys)))])
    paths = [os.path.join(folder, f"range-{i}") for i in range(len(cuts) + 1)]
    for start in range(0, len(keys), CHUNK):
        part = keys[start : start + CHUNK]
        place = np.searchsorted(cuts, part, "right")
        for i in np.unique(place):
            with open(paths[i], "ab") as file:
                file.write((np.flatnonzero(place == i) + start).astype("<i8").tobytes())
    out = np.lib.format.open_memmap(os.path.join(folder, "order.npy"), "w+", np.int64, (len(keys),))
    at = 0
    for path in paths:
        if os.path.exists(path):
            which = np.fromfile(path, "<i8")
            os.unlink(path)
            out[at : at + len(which)] = which[np.argsort(keys[which], kind="stable")]
            at += len(which)
    return out


def types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (S); the end counts as S."""
    n = len(text)
    up = np.empty(n, bool)
    change = np.flatnonzero(text[1:] != text[:-1])
    ascending = text[change] < text[change + 1]
    lengths = np.diff(np.concatenate([[-1], change]))
    up[: len(up) - (n - 1 - (change[-1] if len(change) else -1))] = np.repeat(ascending, lengths)
    up[(change[-1] + 1 if len(change) else 0) :] = True
    return up


def repeated_windows(path: str, length: int, allowed: np.ndarray, depth: int, folder: str) -> np.ndarray:
    """Which ``allowed`` positions of the text file start a ``depth``-byte string that another allowed position starts too.

    The file holds ``length`` symbols, the last one 0, and ``depth`` + 8 zero bytes more.
    """
    full = np.memmap(path, np.uint8, "r")
    text = full[:length]
    is_s = types(text)
    star = is_s.copy()
    star[1:] &= ~is_s[:-1]
    star[0] = False
    stars = np.flatnonzero(star)
    found = np.zeros(length, bool)

    def seeds_of(at: np.ndarray, shared: np.ndarray | None):
        symbols = text[at]
        cuts = np.searchsorted(symbols, np.arange(257))

        def seeds(symbol: int):
            for low in range(int(cuts[symbol]), int(cuts[symbol + 1]), CHUNK):
                high = min(low + CHUNK, int(cuts[symbol + 1]))
                items = np.zeros(high - low, _ITEM)
                items["at"] = at[low:high]
                if shared is not None:
                    items["shared"] = shared[low:high]
                yield items

        return seeds

    # Sort the substrings between seeds: seeds by their first symbol only, then induction.
    taken: list[np.ndarray] = []
    first = stars[np.argsort(text[stars], kind="stable")]
    induce(text, is_s, folder, "names", seeds_of(first, None), 1, lambda at, _: taken.append(at[star[at]]))
    by_name = np.concatenate(taken)[::-1] if taken else stars
    # The last seed, the end of the text, follows no suffix and is the smallest.
    if len(by_name) < len(stars):
        by_name = np.concatenate([stars[-1:], by_name])
    number = np.searchsorted(stars, by_name)
    spans = np.minimum(np.append(np.diff(stars), 1) + 1, depth + 1)[number]
    same = spans[1:] == spans[:-1]
    shared = common(full, by_name[1:], by_name[:-1], depth)
    names = np.cumsum(np.concatenate([[1], ~(same & (shared >= np.minimum(spans[1:], depth)))]))
    rank = np.empty(len(stars) + depth, np.int64)
    rank[len(stars) :] = 0
    rank[number] = names
    step = 1
    while 2 * step < 2 * depth and rank[: len(stars)].max(initial=0) < len(stars):
        keys = rank[: len(stars)] * (len(stars) + 1) + rank[step : step + len(stars)]
        order = order_on_disk(keys, folder)
        ordered = keys[order]
        rank[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
        step *= 2
    order = order_on_disk(rank[: len(stars)], folder)
    seeds = stars[order]
    lengths = np.concatenate([[0], common(full, seeds[1:], seeds[:-1], depth)]) if len(seeds) else np.zeros(0)
    last, least = -1, int(_FAR)

    def emit(at: np.ndarray, shared: np.ndarray) -> None:
        nonlocal last, least
        mine = np.flatnonzero(allowed[at])
        lowest = np.minimum.accumulate(shared)
        if not len(mine):
            least = min(least, int(lowest[-1]))
            return
        between = np.minimum.reduceat(np.append(shared, _FAR), mine + 1)
        if last >= 0 and min(least, int(lowest[mine[0]])) >= depth:
            found[last] = found[at[mine[0]]] = True
        hit = np.flatnonzero(between[:-1] >= depth)
        found[at[mine[hit]]] = True
        found[at[mine[hit + 1]]] = True
        last, least = int(at[mine[-1]]), int(between[-1])

    induce(text, is_s, folder, "all", seeds_of(seeds, lengths), depth, emit)
    return found
