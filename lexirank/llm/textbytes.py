"""Words of whole Arrow columns at once: byte tables and prefix sums in numpy, no Python object per word.

All word rules here separate on ASCII bytes only, so they work on UTF-8 bytes without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64, a bijection of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n + (n >> 2), 1 << 20)
            inverse = np.uint64(pow(int(_ODD), -1, 2**64))
            with np.errstate(over="ignore"):
                cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _ODD)]), dtype=np.uint64)
                cls.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64)
        return cls.up, cls.down


@dataclass
class Words:
    """Words of texts first..first+docs-1 of a batch. starts, ends: byte positions in data; of doc i: bounds[i]..bounds[i+1]."""

    first: int
    docs: int
    data: np.ndarray
    base: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, alike for equal words anywhere."""
        up, down = _Powers.upto(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * up[: len(self.data)], out=sums[1:])
        value = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        return mix(value + (self.ends - self.starts).astype(np.uint64))


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, where, data = texts.buffers()
    if where is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(where, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def words(texts: pa.Array, kept: np.ndarray, block: int = BLOCK) -> Iterator[Words]:
    """Lower-cased (A-Z) words of a string column, null as empty, in blocks of about `block` bytes of whole texts."""
    data, at = _buffers(texts)
    n, i = len(texts), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + block, side="right")) - 1)
        raw = data[at[i] : at[j]]
        low = LOWER[raw]
        base = at[i : j + 1] - at[i]
        inside = kept[raw]
        first, last = inside.copy(), inside.copy()
        if len(raw):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edge = base[1:-1]
            edge = edge[(edge > 0) & (edge < len(raw))]
            first[edge] = inside[edge]
            last[edge - 1] = inside[edge - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        yield Words(i, j - i, low, base, starts, ends, np.searchsorted(starts, base))
        i = j


def shingles(word_hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of each text, and their bounds; a text of fewer words, but not none, has one of all its words."""
    n = np.diff(bounds)
    made = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    doc = np.repeat(np.arange(len(n)), made)
    at = np.arange(out_bounds[-1]) - out_bounds[doc] + bounds[doc]
    padded = np.concatenate([word_hashes, np.zeros(k, np.uint64)])
    value = np.zeros(len(at), dtype=np.uint64)
    for step in range(k):
        there = at + step < bounds[doc + 1]
        value = mix(value * _ODD + np.where(there, padded[at + step], np.uint64(step + 1)))
    return value, out_bounds
