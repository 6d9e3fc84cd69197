"""Induced sorting of suffixes with common-prefix values, for one shard.

Suffixes that start at a local minimum are sorted first, by names of the substrings
between them; all others are induced from these in two scans over the characters. Each
scan takes suffixes from one queue per character, in order, and puts the suffix one
position earlier into the queue of its own character. With every suffix goes the length
of the prefix it shares with the one before it; what an induced pair shares is one more
than the least value between the two that induced it. Queues over the memory allowance
go to disk and are read back when their character is due.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Queue entries held in memory by one sort; further ones go to files of the task.
HELD = 8_000_000


class _Queues:
    """One queue per character: positions and prefix values in order of arrival."""

    def __init__(self, chars: int, held: int):
        self.parts: list[list] = [[] for _ in range(chars)]
        self.low = np.full(chars, -1, np.int64)  # least value since the last arrival; -1: none yet
        self.room = held
        self.folder: tempfile.TemporaryDirectory | None = None
        self.files = 0

    def put(self, char: int, at: np.ndarray, shared: np.ndarray) -> None:
        if self.room >= len(at):
            self.room -= len(at)
            self.parts[char].append((at, shared))
            return
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="queues-")
        name = os.path.join(self.folder.name, f"{self.files}.npy")
        self.files += 1
        np.save(name, np.stack([at, shared]))
        self.parts[char].append(name)

    def take(self, char: int) -> tuple[np.ndarray, np.ndarray]:
        parts, self.parts[char] = self.parts[char], []
        read = []
        for part in parts:
            if isinstance(part, str):
                read.append(tuple(np.load(part)))
                os.remove(part)
            else:
                self.room += len(part[0])
                read.append(part)
        if not read:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([p[0] for p in read]), np.concatenate([p[1] for p in read])

    def induce(self, text: np.ndarray, at: np.ndarray, shared: np.ndarray, keep: np.ndarray) -> None:
        """Put the suffixes before `at` (where `keep`) into the queues of their characters."""
        if not len(at):
            return
        chosen = np.flatnonzero(keep)
        if not len(chosen):
            self.low = np.minimum(self.low, shared.min())
            return
        char = text[at[chosen] - 1]
        order = np.argsort(char, kind="stable")
        chosen, char = chosen[order], char[order]
        cuts = np.flatnonzero(np.r_[True, char[1:] != char[:-1], True])
        before = self.low.copy()
        self.low = np.minimum(self.low, shared.min())
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            c, own = int(char[a]), chosen[a:b]
            starts = np.concatenate([[0], own + 1])
            last = starts[-1] == len(shared)
            least = np.minimum.reduceat(shared, starts[:-1] if last else starts)
            self.low[c] = np.iinfo(np.int64).max if last else least[-1]
            new = least[: len(own)].copy()
            new[0] = min(new[0], before[c])
            self.put(c, at[own] - 1, new + 1)

    def close(self) -> None:
        if self.folder:
            self.folder.cleanup()


def _shared(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at `a` and `b`, up to `depth`."""
    out = np.zeros(len(a), np.int64)
    open_, step = np.arange(len(a)), 8
    padded = np.concatenate([text, np.zeros(depth + step, text.dtype)])
    at = np.arange(step)
    while len(open_):
        base = out[open_, None] + at
        same = padded[a[open_, None] + base] == padded[b[open_, None] + base]
        whole = same.all(axis=1)
        out[open_] += np.where(whole, step, same.argmin(axis=1))
        open_ = open_[whole & (out[open_] < depth)]
    return out


def _scan(text, seeds, seeds_shared, chars, held, depth):
    """Order of all suffixes but the last, from the order of the local minima: lists per
    character of (rising part, falling part), each with prefix values."""
    n = len(text)
    queues = _Queues(chars, held)
    seed_char = text[seeds]
    bounds = np.searchsorted(seed_char, np.arange(chars + 1))
    rising = []
    for c in range(chars):
        parts = []
        at, shared = queues.take(c)
        while len(at):
            parts.append((at, shared))
            queues.induce(text, at, shared, (at > 0) & (text[at - 1] >= c))
            at, shared = queues.take(c)
        own = _joined(parts)
        rising.append(own)
        at, shared = seeds[bounds[c] : bounds[c + 1]], seeds_shared[bounds[c] : bounds[c + 1]].copy()
        if len(at):
            shared[0] = _shared(text, own[0][-1:], at[:1], depth)[0] if len(own[0]) else 0
            queues.induce(text, at, shared, at > 0)
    queues.close()
    queues = _Queues(chars, held)
    falling: list = [None] * chars
    for c in range(chars - 1, -1, -1):
        parts = []
        at, shared = queues.take(c)
        while len(at):
            parts.append((at, shared))
            before = text[at - 1]
            queues.induce(text, at, shared, (at > 0) & (before <= c))
            at, shared = queues.take(c)
        own = falling[c] = _joined(parts)
        up, up_shared = rising[c]
        if len(up):
            at = up[::-1]
            first = _shared(text, own[0][-1:], at[:1], depth) if len(own[0]) else np.zeros(1, np.int64)
            shared = np.concatenate([first, up_shared[:0:-1]])
            queues.induce(text, at, shared, (at > 0) & (text[at - 1] < c))
    queues.close()
    return rising, falling


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _in_order(text, rising, falling, depth) -> tuple[np.ndarray, np.ndarray]:
    order, values = [], []
    for (up, up_shared), (down, down_shared) in zip(rising, falling):
        if len(up):
            order.append(up)
            values.append(np.concatenate([[0], up_shared[1:]]))
        if len(down):
            at = down[::-1]
            first = _shared(text, up[-1:], at[:1], depth) if len(up) else np.zeros(1, np.int64)
            order.append(at)
            values.append(np.concatenate([first, down_shared[:0:-1]]))
    return np.concatenate(order), np.concatenate(values)


def sort_suffixes(text: np.ndarray, depth: int, held: int = HELD) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of `text` in the order of their first `depth` characters, with the length
    of the prefix each shares with the one before (exact below `depth`).

    `text` ends with its only smallest character or with one that also parts its pieces;
    two of these are never neighbours. The last suffix is left out.
    """
    n = len(text)
    chars = int(text.max()) + 1
    differ = np.flatnonzero(text[:-1] != text[1:])
    falls = np.ones(n, bool)  # type S: smaller than the suffix after it
    following = differ[np.minimum(np.searchsorted(differ, np.arange(n - 1)), len(differ) - 1)]
    falls[:-1] = text[following] < text[following + 1]
    minima = np.flatnonzero(falls[1:] & ~falls[:-1]) + 1
    seeds = minima[np.argsort(text[minima], kind="stable")]
    # First induction sorts the substrings between minima; equal ones get one name.
    rising, falling = _scan(text, seeds, np.zeros(len(seeds), np.int64), chars, held, depth)
    is_minimum = np.zeros(n, bool)
    is_minimum[minima] = True
    order = np.concatenate([d[0][::-1] for d in falling])
    order = np.concatenate([[n - 1], order[is_minimum[order]]])
    index = np.empty(n, np.int64)
    index[minima] = np.arange(len(minima))
    order = index[order]
    ends = np.append(minima[1:], n - 1)
    length = ends - minima + 1
    a, b = order[:-1], order[1:]
    longest = int(length.max(initial=1))
    same = (length[a] == length[b]) & (_shared(text, minima[a], minima[b], longest) >= length[a])
    name = np.empty(len(minima), np.int64)
    name[order] = np.concatenate([[0], np.cumsum(~same)])
    # Minima by the names that follow, twice as many in each round.
    step = 1
    while step * 2 < 2 * depth and name.max(initial=0) + 1 < len(name):
        later = np.zeros(len(name), np.int64)
        later[:-step] = name[step:] + 1
        key = name * (len(name) + 1) + later
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        name[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        step *= 2
    seeds = minima[np.argsort(name, kind="stable")]
    shared = np.zeros(len(seeds), np.int64)
    shared[1:] = _shared(text, seeds[:-1], seeds[1:], depth)
    rising, falling = _scan(text, seeds, shared, chars, held, depth)
    return _in_order(text, rising, falling, depth)


def repeated_starts(pieces: list[bytes], length: int, held: int = HELD) -> list[np.ndarray]:
    """For each piece which of its `length`-byte strings start anywhere else, in it or
    in another piece."""
    pieces_length = np.array([len(p) for p in pieces])
    text = np.zeros(int((pieces_length + 1).sum()), np.uint16)
    ends = np.cumsum(pieces_length + 1) - 1
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 1
    order, shared = sort_suffixes(text, length, held)
    room = np.repeat(ends, pieces_length + 1) - np.arange(len(text))
    whole = room[order] >= length
    group = np.cumsum(shared < length)
    counts = np.bincount(group, weights=whole)
    again = np.zeros(len(text), bool)
    again[order] = whole & (counts[group] >= 2)
    return [again[e - n : e - n + max(0, n - length + 1)] for e, n in zip(ends.tolist(), pieces_length.tolist())]
