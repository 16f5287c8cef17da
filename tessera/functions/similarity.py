"""Similarities of strings and token sets.

Token sets are Catalyst expressions.  Ratios of longest common subsequences have
no Spark counterpart: they run in Arrow batches, once for each different pair of
a batch, bit-parallel and for many pairs at once.  `ratio`, `sorted_ratio` and
`set_ratio` are the same for one pair.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by the bit-vector recurrence of Hyyro (2004)."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        hit = v & where.get(c, 0)
        v = ((v + hit) | (v - hit)) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    return 1.0 if not a and not b else 2 * lcs(a, b) / (len(a) + len(b))


def sorted_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 1.0
    left, right = (" ".join(filter(None, (both, " ".join(sorted(s))))) for s in (x - y, y - x))
    return max([ratio(left, right), *((ratio(both, left), ratio(both, right)) if both else ())])


#: Longest pattern of the table below, in words of 64 bits, and the cells of masks held at once.
_WORDS, _CELLS = 16, 1 << 22


def lcs_many(a: list[str], b: list[str]) -> np.ndarray:
    """lcs of each pair: the same recurrence for many pairs at once, a pattern in words of 64 bits."""
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    words = -(-la // 64)
    out = np.zeros(len(a), np.int64)
    for w in np.unique(words[(la > 0) & (lb > 0)]).tolist():
        own = np.flatnonzero((words == w) & (lb > 0))
        if w > _WORDS:
            for k in own.tolist():
                out[k] = lcs(a[k], b[k])
            continue
        own = own[np.argsort(lb[own], kind="stable")]  # pairs of like lengths together
        step = max(1, _CELLS // (64 * w))
        for i in range(0, len(own), step):
            some = own[i : i + step]
            out[some] = _lcs_block([a[k] for k in some], [b[k] for k in some], la[some], lb[some], w)
    return out


def _lcs_block(a: list[str], b: list[str], la: np.ndarray, lb: np.ndarray, w: int) -> np.ndarray:
    n, one = len(a), np.uint64(1)
    raw = np.frombuffer("".join((*a, *b)).encode("utf-32-le"), "<u4")
    symbols, code = np.unique(raw, return_inverse=True)
    if len(symbols) > 512 and n > 1:  # masks for each symbol: halve the block
        half = n // 2
        return np.concatenate((_lcs_block(a[:half], b[:half], la[:half], lb[:half], w), _lcs_block(a[half:], b[half:], la[half:], lb[half:], w)))
    total = int(la.sum())
    row, at = np.repeat(np.arange(n), la), np.arange(total) - np.repeat(np.cumsum(la) - la, la)
    masks = np.zeros((n, len(symbols) + 1, w), np.uint64)
    np.bitwise_or.at(masks, (row, code[:total], at >> 6), one << (at & 63).astype(np.uint64))
    text = np.full((int(lb.max()), n), len(symbols))  # places after the end hit nothing
    row = np.repeat(np.arange(n), lb)
    text[np.arange(len(row)) - np.repeat(np.cumsum(lb) - lb, lb), row] = code[total:]
    bits = np.clip(la[:, None] - 64 * np.arange(w), 0, 64).astype(np.uint64)
    full = np.where(bits == 64, ~np.uint64(0), (one << (bits % np.uint64(64))) - one)
    v, each, total_v = full.copy(), np.arange(n), np.empty((n, w), np.uint64)
    for c in text:
        hit = v & masks[each, c]
        if w == 1:
            total_v = v + hit
        else:
            carry = np.zeros(n, bool)
            for k in range(w):
                x = v[:, k] + hit[:, k]
                y = x + carry
                carry = (x < v[:, k]) | (y < x)
                total_v[:, k] = y
        v = (total_v | (v ^ hit)) & full
    return la - np.bitwise_count(v).sum(axis=1, dtype=np.int64)


def _ratios(a: list[str], b: list[str], empty: float) -> np.ndarray:
    size = np.fromiter(map(len, a), np.int64, len(a)) + np.fromiter(map(len, b), np.int64, len(b))
    return np.where(size == 0, empty, 2 * lcs_many(a, b) / np.maximum(size, 1))


def _sorted_ratios(a: list[str], b: list[str], empty: float) -> np.ndarray:
    known = {x: " ".join(sorted(x.split())) for x in {*a, *b}}
    return np.where([not x and not y for x, y in zip(a, b, strict=True)], empty, _ratios([known[x] for x in a], [known[x] for x in b], 1.0))


def _set_ratios(a: list[str], b: list[str], empty: float) -> np.ndarray:
    """What both share stands first on both sides, so that only the rests need a subsequence."""
    tokens = {x: frozenset(x.split()) for x in {*a, *b}}
    out, left, right, shared = np.full(len(a), empty), [], [], []
    rest = []
    for k, (p, q) in enumerate(zip(a, b, strict=True)):
        x, y = tokens[p], tokens[q]
        if not x or not y:
            continue
        both = " ".join(sorted(x & y))
        if both and (x <= y or y <= x):
            out[k] = 1.0
            continue
        rest.append(k)
        shared.append(len(both) + bool(both))
        left.append(" ".join(sorted(x - y)))
        right.append(" ".join(sorted(y - x)))
    if rest:
        n = np.array(shared)
        l, r = (np.fromiter(map(len, x), np.int64, len(x)) for x in (left, right))  # noqa: E741
        whole = 2 * (n + lcs_many(left, right)) / (2 * n + l + r)
        alone = np.where(n > 0, 2 * (n - 1) / np.maximum(2 * n - 1 + np.minimum(l, r), 1), 0)  # of what is shared and the shorter side
        out[rest] = np.maximum(whole, alone)
    return out


def _vectorised(f: Callable[[list[str], list[str], float], np.ndarray], empty: float):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        # each different pair once; equal strings need no subsequence
        pairs = pd.MultiIndex.from_arrays([a.fillna(""), b.fillna("")])
        place, different = pairs.factorize()
        left, right = list(different.get_level_values(0)), list(different.get_level_values(1))
        return pd.Series(f(left, right, empty)[place] if len(left) else [], dtype="float64")

    return run


fuzz_ratio = _vectorised(_ratios, 1.0)
fuzz_ratio_or_zero = _vectorised(_ratios, 0.0)
fuzz_sort = _vectorised(_sorted_ratios, 1.0)
fuzz_set = _vectorised(_set_ratios, 0.0)


def token_set(text: Column, separator: str = " ") -> Column:
    return F.array_distinct(F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), ""))


def jaccard(a: Column, b: Column, empty: float, common: Column | None = None) -> Column:
    """Of two sets; `empty` where both are empty.  common: the size of their intersection, if it is known."""
    common = F.size(F.array_intersect(a, b)) if common is None else common
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(empty)).otherwise(common / union)
