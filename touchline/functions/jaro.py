"""Jaro-Winkler similarity as whole points from 0 to 100.

Common prefixes of up to four letters raise the score, by a tenth each, where
the plain Jaro value is above 0.7. Two empty texts score 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

BOOST_ABOVE = 0.7
PREFIX_SCALE = 0.1
PREFIX_MAX = 4


def boosted(jaro: float, prefix: int) -> float:
    return jaro + PREFIX_SCALE * prefix * (1.0 - jaro) if jaro > BOOST_ABOVE else jaro


def points(similarity: float) -> int:
    return math.floor(100.0 * similarity + 0.5)


def similarity_points(a: str, b: str) -> int:
    """Similarity of two texts, rounded half up."""
    if not a or not b:
        return 0
    if a == b:
        return 100
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = list(b)
    from_a, positions = [], []
    for i, letter in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] == letter:
                free[j] = None
                from_a.append(letter)
                positions.append(j)
                break
    m = len(from_a)
    if not m:
        return 0
    from_b = [b[j] for j in sorted(positions)]
    swaps = sum(x != y for x, y in zip(from_a, from_b)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3.0
    prefix = 0
    for x, y in zip(a[:PREFIX_MAX], b[:PREFIX_MAX]):
        if x != y:
            break
        prefix += 1
    return points(boosted(jaro, prefix))


#: Letters of a batch of pairs compared at once, and what stands where no letter is left.
BATCH_LETTERS = 1 << 20
_USED, _END_A, _END_B = (np.uint32(0xFFFFFFFF - k) for k in range(3))


def coded(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All letters in a row, where each text begins, and how long it is."""
    sizes = np.array([len(t) for t in texts], np.int64)
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return letters, np.cumsum(sizes) - sizes, sizes


def similarity_points_of(a: tuple, b: tuple, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """`similarity_points` of many pairs at once, of texts `row` of `a` and `col` of `b`
    (see `coded`)."""
    (a_letters, a_starts, a_sizes), (b_letters, b_starts, b_sizes) = a, b
    out = np.zeros(len(row), np.int64)
    longest = np.maximum(a_sizes[row], b_sizes[col])
    width = 1 << np.ceil(np.log2(np.maximum(longest, 1))).astype(np.int64)  # texts of like length together
    for w in np.unique(width).tolist():
        alike = np.flatnonzero((width == w) & (a_sizes[row] > 0) & (b_sizes[col] > 0))
        for part in np.array_split(alike, math.ceil(len(alike) * w / BATCH_LETTERS) or 1):
            if len(part):
                i, j = row[part], col[part]
                first, other = _padded(a_letters, a_starts[i], a_sizes[i], _END_A), _padded(b_letters, b_starts[j], b_sizes[j], _END_B)
                out[part] = _points(first, other, a_sizes[i], b_sizes[j])
    return out


def _padded(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, end: np.uint32) -> np.ndarray:
    at = np.arange(sizes.max())
    inside = at < sizes[:, None]
    return np.where(inside, letters[np.where(inside, starts[:, None] + at, 0)], end)


def _points(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    free, at, every = b.copy(), np.arange(b.shape[1]), np.arange(len(a))
    found = np.zeros(a.shape, bool)
    for i in range(a.shape[1]):
        low, high = max(0, i - int(reach.max())), i + int(reach.max()) + 1
        near = (free[:, low:high] == a[:, i, None]) & (np.abs(at[low:high] - i) <= reach[:, None])
        if near.shape[1]:
            first = near.argmax(axis=1)
            hit = found[:, i] = near[every, first]
            free[every[hit], low + first[hit]] = _USED
    matches = found.sum(axis=1)
    rows = np.nonzero(found)[0]
    swaps = np.bincount(rows[a[found] != b[free == _USED]], minlength=len(a)) // 2
    some = np.maximum(matches, 1)
    jaro = (matches / n + matches / m + (matches - swaps) / some) / 3.0
    k = min(PREFIX_MAX, a.shape[1], b.shape[1])
    prefix = np.cumprod(a[:, :k] == b[:, :k], axis=1).sum(axis=1)
    near = np.where(jaro > BOOST_ABOVE, jaro + PREFIX_SCALE * prefix * (1.0 - jaro), jaro)
    return np.where(matches > 0, np.floor(100.0 * near + 0.5), 0).astype(np.int64)


@F.pandas_udf(T.IntegerType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Arrow-batched column form; null where either side is null."""
    return pd.Series(
        [None if x is None or y is None else similarity_points(x, y) for x, y in zip(a, b)],
        dtype="Int32",
    )
