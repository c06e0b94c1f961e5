"""String similarities without a built-in counterpart, as Arrow functions over distinct values."""

from __future__ import annotations

import numpy as np
import pandas as pd

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jaro(a: bytes, b: bytes) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    rest, left = bytearray(b), bytearray()
    for i, c in enumerate(a):
        j = rest.find(c, max(0, i - reach), i + reach + 1)
        if j >= 0:
            rest[j] = 0xFF  # no byte of UTF-8 text
            left.append(c)
    m = len(left)
    if not m:
        return 0.0
    right = bytes(c for c, r in zip(b, rest) if r == 0xFF)
    half = sum(x != y for x, y in zip(left, right)) // 2
    return (m / len(a) + m / len(b) + (m - half) / m) / 3


def jaro_winkler_value(a: str | None, b: str | None) -> float | None:
    """Over UTF-8 bytes; a common start of up to four bytes counts only above a Jaro value of 0.7."""
    if a is None or b is None:
        return None
    x, y = a.encode(), b.encode()
    base = jaro(x, y)
    if base <= 0.7:
        return base
    start = 0
    for p, q in zip(x[:4], y[:4]):
        if p != q:
            break
        start += 1
    return base + start * 0.1 * (1 - base)


def jaro_winkler_many(a: list[str | None], b: list[str | None]) -> np.ndarray:
    """``jaro_winkler_value`` of many pairs; NaN where a side is null. Each distinct pair is compared once."""
    known = {p: jaro_winkler_value(*p) for p in set(zip(a, b))}
    return np.array([known[p] for p in zip(a, b)], np.float64)


def with_nulls(values: np.ndarray):
    return pd.arrays.FloatingArray(values, np.isnan(values))


def jaro_winkler(a, b) -> Column:
    return F.pandas_udf(jaro_winkler_values, T.DoubleType())(a, b)


def jaro_winkler_values(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(with_nulls(jaro_winkler_many(a.tolist(), b.tolist())))


def jaro_winklers(**pairs: tuple[str, str]) -> Column:
    """A struct of several Jaro-Winkler similarities in one pass; null where a side is null."""
    names = list(pairs)
    kind = T.StructType([T.StructField(n, T.DoubleType()) for n in names])

    def values(*columns: pd.Series) -> pd.DataFrame:
        found = {n: jaro_winkler_many(columns[2 * k].tolist(), columns[2 * k + 1].tolist()) for k, n in enumerate(names)}
        return pd.DataFrame({n: with_nulls(v) for n, v in found.items()})

    return F.pandas_udf(values, kind)(*(F.col(c) for pair in pairs.values() for c in pair))


def matching_share(a: str, b: str) -> float:
    """2 * longest common subsequence / total length, as a percentage: the indel ratio."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for c in a:
        before = 0
        for j, d in enumerate(b, 1):
            kept = row[j]
            row[j] = before + 1 if c == d else max(row[j], row[j - 1])
            before = kept
    return 200.0 * row[-1] / (len(a) + len(b))


def token_sort_share(a: str, b: str) -> float:
    return matching_share(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_share(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, one, two = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not one or not two):
        return 100.0
    first, second = f"{both} {one}".strip(), f"{both} {two}".strip()
    return max(matching_share(first, second), *([matching_share(both, first), matching_share(both, second)] if both else [0.0]))


def fuzzy_ratios(a, b) -> Column:
    """A struct of ratio, token_sort and token_set, as percentages."""
    return F.pandas_udf(fuzzy_values, T.StructType([T.StructField(n, T.DoubleType()) for n in ("ratio", "token_sort", "token_set")]))(a, b)


#: Pairs that are compared together, and cells of their table of letters at most.
TOGETHER, TABLE = 4096, 1 << 21


def long_common(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit by bit of ``a`` in one integer."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for c in b:
        met = row & at.get(c, 0)
        row = (row + met | row - met) & whole
    return len(a) - row.bit_count()


def common_many(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the longest common subsequences of many pairs: those whose shorter text has up to 64 letters side by side."""
    if len(a) > TOGETHER:
        return np.concatenate([common_many(a[k : k + TOGETHER], b[k : k + TOGETHER]) for k in range(0, len(a), TOGETHER)])
    out = np.zeros(len(a), np.int64)
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    rows = [k for k, (x, _) in enumerate(pairs) if len(x) <= 64]
    short = {x: k for k, x in enumerate(dict.fromkeys(pairs[k][0] for k in rows))}
    other = {x: k for k, x in enumerate(dict.fromkeys(pairs[k][1] for k in rows))}
    letters, place = np.unique(np.frombuffer("".join(short).encode("utf-32-le"), np.uint32), return_inverse=True)
    widest = max(map(len, other), default=0)
    if len(short) * (len(letters) + 1) > TABLE or len(other) * widest > TABLE:
        if len(a) > 64:
            half = len(a) // 2
            return np.concatenate([common_many(a[:half], b[:half]), common_many(a[half:], b[half:])])
        rows = []
    else:
        sizes = np.array([len(x) for x in short], np.int64)
        bit = np.uint64(1) << (np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.uint64)
        masks = np.zeros((len(short), len(letters) + 1), np.uint64)
        np.bitwise_or.at(masks, (np.repeat(np.arange(len(short)), sizes), place), bit)
        flat = np.frombuffer("".join(other).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(letters, flat)
        at[(at == len(letters)) | (letters[np.minimum(at, len(letters) - 1)] != flat if len(letters) else True)] = len(letters)
        sizes_b = np.array([len(x) for x in other], np.int64)
        grid = np.full((widest, len(other)), len(letters), np.int64)
        grid[np.arange(len(flat)) - np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_b), np.repeat(np.arange(len(other)), sizes_b)] = at
        i, j = np.array([short[pairs[k][0]] for k in rows], np.int64), np.array([other[pairs[k][1]] for k in rows], np.int64)
        row, base, cells = np.full(len(rows), 2**64 - 1, np.uint64), i * (len(letters) + 1), masks.ravel()
        with np.errstate(over="ignore"):
            for step in grid:
                met = row & cells[base + step[j]]
                row = row + met | row - met
        whole = np.where(sizes < 64, (np.uint64(1) << np.minimum(sizes, 63).astype(np.uint64)) - np.uint64(1), np.uint64(2**64 - 1))[i] if len(rows) else row
        out[rows] = np.bitwise_count(~row & whole)
    done = set(rows)
    for k, (x, y) in enumerate(pairs):
        if k not in done:
            out[k] = long_common(x, y)
    return out


def shares(a: list[str], b: list[str]) -> np.ndarray:
    """``matching_share`` of many pairs."""
    total = np.array([len(x) + len(y) for x, y in zip(a, b)], np.int64)
    return np.where(total > 0, 200.0 * common_many(a, b) / np.maximum(total, 1), 100.0)


def fuzzy_values(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """The three ratios of many pairs. The common words begin either text of the token set, so that their share needs no comparison."""
    rows = [(x or "", y or "") for x, y in zip(a, b)]
    pairs = {p: k for k, p in enumerate(dict.fromkeys(rows))}
    words = {x: x.split() for p in pairs for x in p}
    ordered, held = {x: " ".join(sorted(w)) for x, w in words.items()}, {x: frozenset(w) for x, w in words.items()}
    known, left, right, at = np.zeros(len(pairs)), [], [], []
    for k, (p, q) in enumerate(pairs):
        x, y = held[p], held[q]
        if not x or not y:
            continue
        same = x & y
        if same and (len(same) == len(x) or len(same) == len(y)):
            known[k] = 100.0
            continue
        both, one, two = " ".join(sorted(same)), " ".join(sorted(x - same)), " ".join(sorted(y - same))
        first, second = (f"{both} {one}", f"{both} {two}") if both else (one, two)
        if both:
            known[k] = 200.0 * len(both) / (len(both) + min(len(first), len(second)))
        left.append(first)
        right.append(second)
        at.append(k)
    sets = known
    if at:
        sets[at] = np.maximum(known[at], shares(left, right))
    p, q = [x for x, _ in pairs], [y for _, y in pairs]
    made = {"ratio": shares(p, q), "token_sort": shares([ordered[x] for x in p], [ordered[y] for y in q]), "token_set": sets}
    back = np.array([pairs[p] for p in rows], np.int64)
    return pd.DataFrame({n: v[back] for n, v in made.items()})
