"""Nearest names among those that hold nearly the same letters.

A name that scores well shares all but a few of its letters. Such names are looked up
by sums of their letters' hashes, less one or two of them, and by hashes of the text
without one letter; for each name the highest score that any other could have is told
as well. Finding is exact: whatever is looked up is compared letter by letter.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np

from touchline import config
from touchline.functions.jaro import BOOST_ABOVE, PREFIX_MAX, PREFIX_SCALE, coded, similarity_points_of

#: Keys and pairs of names held at a time; market names whose texts are cut at a time.
HELD_KEYS = 2_000_000
HELD_PAIRS = 500_000
CUT_ROWS = 50_000
#: Market names before and behind a name in order that are compared with it at the end.
NEIGHBOURS = 4
#: Pairs of teams whose points are held as a matrix.
TEAM_PAIRS = 1_000_000
#: Odd, so that texts' hashes, sums of its powers, can be divided by it.
_BASE = 0x9E3779B97F4A7C15


def _mixed(letters: np.ndarray) -> np.ndarray:
    """64 bits of hash per letter."""
    x = letters.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def highest_points(n, m, shared, swaps=0) -> np.ndarray:
    """Upper bound in points on the similarity of names of `n` and `m` letters that share
    so many, `swaps` of them out of order."""
    n, m, shared = (np.asarray(x, np.float64) for x in (n, m, shared))
    some = np.maximum(shared, 1)
    jaro = np.where(shared > 0, (shared / np.maximum(n, 1) + shared / np.maximum(m, 1) + (some - swaps) / some) / 3, 0)
    boost = PREFIX_SCALE * PREFIX_MAX
    high = np.where(jaro > BOOST_ABOVE - 1e-5, jaro * (1 - boost) + boost, jaro)
    return np.floor(high * 100 + 0.5 + 1e-3).astype(np.int64)


class _Names:
    """Names by their letters, and the bags of letters among them."""

    def __init__(self, texts: list[str]):
        self.codes = self.letters, self.starts, self.sizes = coded(texts)
        self.ends = self.starts + self.sizes
        self.hashes = _mixed(self.letters)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes, dtype=np.uint64)])
        sums = total[self.ends] - total[self.starts]
        self.order = np.argsort(sums, kind="stable")
        self.bags, self.first, self.count = np.unique(sums[self.order], return_index=True, return_counts=True)
        self.bag_size = self.sizes[self.order[self.first]]
        self.bag_of = np.searchsorted(self.bags, sums)

    def less(self, gone: int, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Bags and their sums without any one or two (`gone`) of their letters."""
        if not gone:
            yield some, self.bags[some]
            return
        for n in np.unique(self.bag_size[some]).tolist():
            alike = some[self.bag_size[some] == n]
            if n < gone:
                continue
            i, j = np.triu_indices(n, 1)
            step = max(1, HELD_KEYS // (n if gone == 1 else len(i)))
            for at in range(0, len(alike), step):
                part = alike[at : at + step]
                starts = self.starts[self.order[self.first[part]]]
                one = np.sort(self.hashes[starts[:, None] + np.arange(n)], axis=1)
                again = np.zeros(one.shape, bool)
                again[:, 1:] = one[:, 1:] == one[:, :-1]
                if gone == 1:
                    row, col = np.nonzero(~again)
                    yield part[row], self.bags[part[row]] - one[row, col]
                else:
                    # Different letters, or the first two of a kind.
                    third = np.zeros(one.shape, bool)
                    third[:, 2:] = again[:, 2:] & again[:, 1:-1]
                    both = ~again[:, i] & ~again[:, j]
                    both |= (j == i + 1) & ~again[:, i] & again[:, j] & ~third[:, j]
                    row, pair = np.nonzero(both)
                    yield part[row], self.bags[part[row]] - one[row, i[pair]] - one[row, j[pair]]

    def cut(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Names and hashes of their texts without any one of their letters."""
        size = self.sizes[some]
        name = np.repeat(some, size)
        ends = np.cumsum(size)
        place = np.arange(len(name)) - np.repeat(ends - size, size)
        at = self.starts[name] + place
        powers = np.cumprod(np.full(int(size.max(initial=0)) + 1, _BASE, np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes[at] * powers[place], dtype=np.uint64)])
        before = sums[:-1] - np.repeat(sums[ends - size], size)
        after = np.repeat(sums[ends], size) - sums[1:]
        keys = before + after * np.uint64(pow(_BASE, -1, 1 << 64))
        # Of letters that repeat, leaving out either gives one text.
        new = (place == 0) | (self.letters[at] != self.letters[np.maximum(at - 1, 0)])
        return name[new], keys[new]


class _Keys:
    """Places of keys, which may repeat, among sorted ones."""

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        bits = min(24, max(10, int(16 * len(keys)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.known = np.zeros(1 << bits, bool)
        self.known[(keys >> self.shift).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `keys` is which of the known ones."""
        some = np.flatnonzero(self.known[(keys >> self.shift).astype(np.int64)])
        low = np.searchsorted(self.keys, keys[some])
        held = low < len(self.keys)
        some, low = some[held], low[held]
        equal = self.keys[low] == keys[some]
        some, low = some[equal], low[equal]
        high = np.searchsorted(self.keys, keys[some], side="right")
        which, each = _spread(high - low)
        return some[which], self.order[low[which] + each]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of so many: the group of each member, and its number in the group."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


def _parts(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Runs of groups of about `most` members in all, or of one group."""
    ends, at = np.cumsum(counts), 0
    while at < len(counts):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        yield slice(at, max(to, at + 1))
        at = max(to, at + 1)


class _Teams:
    """Points of pairs of teams, weighted and with those for equal ones."""

    def __init__(self, own: list[str], market: list[str]):
        self.own, self.own_of = np.unique(np.array(own, object), return_inverse=True)
        self.market, self.market_of = np.unique(np.array(market, object), return_inverse=True)
        self.codes = coded(self.own.tolist()), coded(self.market.tolist())
        weights = config.MATCH_WEIGHTS
        if len(self.own) * len(self.market) <= TEAM_PAIRS:
            row, col = np.divmod(np.arange(len(self.own) * len(self.market)), len(self.market))
            self.matrix = np.stack(self._points(row, col)).reshape(2, len(self.own), len(self.market))
            self.most = self._weighted(*self.matrix).max(axis=1)[self.own_of]
        else:
            self.matrix = None
            same = np.isin(self.own, self.market)
            self.most = np.where(same, 100 * weights["team"] + weights["same_team"], 99 * weights["team"])[self.own_of]

    def _points(self, row: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return similarity_points_of(*self.codes, row, col), (self.own[row] == self.market[col]).astype(np.int64)

    @staticmethod
    def _weighted(points: np.ndarray, same: np.ndarray) -> np.ndarray:
        return config.MATCH_WEIGHTS["team"] * points + config.MATCH_WEIGHTS["same_team"] * same

    def of(self, row: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Points, whether it is one team, and both weighted, of pairs of names."""
        row, col = self.own_of[row], self.market_of[col]
        if self.matrix is not None:
            ts, tm = self.matrix[0, row, col], self.matrix[1, row, col]
        else:
            pair, which = np.unique(row * len(self.market) + col, return_inverse=True)
            ts, tm = (x[which] for x in self._points(*np.divmod(pair, len(self.market))))
        return ts, tm, self._weighted(ts, tm)


class _Best:
    """The best market name of each name so far; of equal scores the letter-for-letter equal
    name, then the first of the market names."""

    def __init__(self, cleans: list[str], sames: list[str], market: list[str], market_sames: list[str]):
        self.names, self.market = _Names(cleans), _Names(market)
        self.teams = _Teams(sames, market_sames)
        self.texts, self.market_texts = np.array(cleans, object), np.array(market, object)
        self.found = np.zeros((6, len(cleans)), np.int64)
        self.score, self.unlike, self.col = self.found[:3]
        self.score[:] = -1

    def may_gain(self, lost: int, more: int) -> np.ndarray:
        """Names that could score as high with one that lacks `lost` of their letters and
        has `more` others."""
        n = self.names.sizes
        points = highest_points(n, n - lost + more, n - lost)
        return (n >= lost) & (config.MATCH_WEIGHTS["name"] * points + self.teams.most >= self.score)

    def offer_bags(self, lost: int, more: int) -> None:
        """Names of bags that are equal without so many letters of either side."""
        ours, theirs = self.names, self.market
        some = np.unique(ours.bag_of[self.may_gain(lost, more)])
        theirs_some = np.flatnonzero(np.isin(theirs.bag_size, np.unique(ours.bag_size[some]) - lost + more))
        if not len(some) or not len(theirs_some):
            return
        if more:
            keys = _Keys(ours.bags[some])
            for bags, sums in theirs.less(more, theirs_some):
                which, own = keys.find(sums)
                self._offer(some[own], bags[which], lost)
        else:
            keys = _Keys(theirs.bags[theirs_some])
            for bags, sums in ours.less(lost, some):
                which, other = keys.find(sums)
                self._offer(bags[which], theirs_some[other], lost)

    def offer_cut(self) -> None:
        """Names of equal length whose texts are equal without one letter of each."""
        some = np.flatnonzero(self.may_gain(1, 1))
        theirs = np.flatnonzero(np.isin(self.market.sizes, np.unique(self.names.sizes[some])))
        if not len(some) or not len(theirs):
            return
        names, cuts = self.names.cut(some)
        keys = _Keys(cuts)
        for at in range(0, len(theirs), CUT_ROWS):
            other, sums = self.market.cut(theirs[at : at + CUT_ROWS])
            which, own = keys.find(sums)
            row, col = names[own], other[which]
            alike = self.names.sizes[row] == self.market.sizes[col]
            self._compare(row[alike], col[alike], 1)

    def offer_neighbours(self, each: int) -> None:
        """For names that something else may beat, market names next to them by text, within
        their team and within all: of these scores some are near the best."""
        some = np.flatnonzero(self.score <= self.beyond())
        if not len(some):
            return
        texts, market = self.texts.tolist(), self.market_texts.tolist()
        for own, other in ((self.teams.own[self.teams.own_of], self.teams.market[self.teams.market_of]), (None, None)):
            listed = market if other is None else list(zip(other.tolist(), market))
            order = np.array(sorted(range(len(listed)), key=listed.__getitem__))
            ranked = [listed[k] for k in order.tolist()]
            at = np.array([bisect_left(ranked, texts[i] if own is None else (own[i], texts[i])) for i in some.tolist()])
            for shift in range(-each, each):
                self._compare(some, order[np.clip(at + shift, 0, len(order) - 1)], 0)

    def _offer(self, own: np.ndarray, other: np.ndarray, lost: int) -> None:
        ours, theirs = self.names, self.market
        for some in _parts(ours.count[own], HELD_KEYS):
            which, each = _spread(ours.count[own[some]])
            row, bag = ours.order[ours.first[own[some]][which] + each], other[some][which]
            # Most of what is left is needed for few names.
            n, m = ours.sizes[row], theirs.bag_size[bag]
            high = config.MATCH_WEIGHTS["name"] * highest_points(n, m, n - lost) + self.teams.most[row]
            still = high >= self.score[row]
            row, bag = row[still], bag[still]
            for part in _parts(theirs.count[bag], HELD_PAIRS):
                which, each = _spread(theirs.count[bag[part]])
                self._compare(row[part][which], theirs.order[theirs.first[bag[part]][which] + each], lost)

    def _compare(self, row: np.ndarray, col: np.ndarray, lost: int) -> None:
        weight = config.MATCH_WEIGHTS["name"]
        n, m = self.names.sizes[row], self.market.sizes[col]
        ts, tm, teams = self.teams.of(row, col)
        some = np.flatnonzero(weight * highest_points(n, m, n - lost) + teams >= self.score[row])
        row, col, ts, tm, teams = (x[some] for x in (row, col, ts, tm, teams))
        ns = similarity_points_of(self.names.codes, self.market.codes, row, col)
        score = weight * ns + teams
        some = np.flatnonzero(score >= self.score[row])
        row, col, ts, tm, ns, score = (x[some] for x in (row, col, ts, tm, ns, score))
        unlike = (self.texts[row] != self.market_texts[col]).astype(np.int64)
        order = np.lexsort((col, unlike, -score, row))
        order = order[np.r_[True, row[order][1:] != row[order][:-1]]] if len(order) else order
        row, col, unlike, ts, tm, ns, score = (x[order] for x in (row, col, unlike, ts, tm, ns, score))
        had = self.score[row]
        better = (score > had) | ((score == had) & ((unlike < self.unlike[row]) | ((unlike == self.unlike[row]) & (col < self.col[row]))))
        self.found[:, row[better]] = np.stack([score, unlike, col, ns, ts, tm])[:, better]

    def beyond(self) -> np.ndarray:
        """The highest score of each name with any market name that was not looked up: one
        that lacks a letter, has another and has two out of order, or differs by more."""
        n, sizes = self.names.sizes, self.market.sizes
        other = highest_points(n, n, n - 1, 1)
        other = np.maximum(other, highest_points(n, n - 1, n - 2))
        for lost, more, exists in ((1, 2, n + 1 <= sizes.max()), (0, 3, n + 3 <= sizes.max()), (3, 0, n - 3 >= sizes.min())):
            other = np.where(exists, np.maximum(other, highest_points(n, n - lost + more, n - lost)), other)
        return config.MATCH_WEIGHTS["name"] * other + self.teams.most


def near_in_letters(
    cleans: list[str], sames: list[str], market: list[str], market_sames: list[str]
) -> tuple[list[tuple], list[int]]:
    """For names and their teams: (place of the best market name that holds nearly their
    letters, score, its parts), with a score of -1 for none, and the highest score that any
    of the others could have."""
    best = _Best(cleans, sames, market, market_sames)
    for lost, more in ((0, 0), (1, 0), (0, 1)):
        best.offer_bags(lost, more)
    best.offer_cut()
    for lost, more in ((2, 0), (0, 2)):
        best.offer_bags(lost, more)
    best.offer_neighbours(NEIGHBOURS)
    score, _, col, ns, ts, tm = best.found.tolist()
    return list(zip(col, score, ns, ts, tm)), best.beyond().tolist()
