"""Vectorised text kernels: words, hashes and shingles straight from Arrow buffers.

A text is UTF-8 bytes. A word is a run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return, with A-Z lower-cased. All hashes are 64 bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space bytes, lower-casing of A-Z, hash multipliers.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15
STEP = np.uint64(0xD6E8FEB86659FD93)
MASK64 = (1 << 64) - 1

#: Bytes of text that are held in expanded form at a time.
PIECE = 1 << 20

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 12, len(_powers[0]) * 5 // 4)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most ``limit`` bytes of text (one row at least), bytes and offsets.

    A null text counts as empty.
    """
    texts = batch.column(column)
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        part = batch.slice(at, stop - at)
        yield part, *flat(part.column(column))
        at = stop


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, held = texts.buffers()
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of some texts: byte ranges, hashes, and for each text the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def texts(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of byte * BASE**i, from which the hash of any range follows."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> Words:
    inside = ~SPACE[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashes = range_hash(prefix_hash(LOWER[data] if lower else data), starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def shingle_sets(found: Words, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    A text with fewer words has its whole sequence as its one shingle, one without words none.
    """
    h, first = found.hashes, found.first
    n = len(h)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, n - width + 1), np.uint64)
        for k in range(width):
            rolled = rolled * STEP + h[k : k + len(rolled)]
        rolled = mix(rolled)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= width:
                out.append(np.unique(rolled[a : b - width + 1]))
            elif b > a:
                whole = np.zeros(1, np.uint64)
                for k in range(a, b):
                    whole = whole * STEP + h[k : k + 1]
                out.append(mix(whole + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
