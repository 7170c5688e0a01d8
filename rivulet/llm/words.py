"""Words of texts as hash arrays, for use inside Arrow tasks.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D). All functions
work on whole Arrow batches of texts: no text is cut, and a null text has no words. Equal
words have equal 64-bit hashes; sequences are told apart by 128-bit digests.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, extended when needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate(
                [self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))]
            )
            self.down = np.concatenate(
                [self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))]
            )


_BYTES, _LANES = _Powers(_BASE), (_Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F))


class Words:
    """The words of a batch: `starts` and `ends` in `data`, `first` word of each text."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        size = int(bounds[-1] - bounds[0])
        if size:
            data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
        else:
            data = np.zeros(0, np.uint8)
        self.bounds = bounds = bounds - bounds[0]
        solid = _SOLID[data]
        before, after = np.zeros(size, bool), np.zeros(size, bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        before[bounds[bounds < size]] = False
        after[bounds[bounds > 0] - 1] = False
        self.data = data
        self.starts = np.flatnonzero(solid & ~before)
        self.ends = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.starts, bounds)

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A hash of every word; `lower` makes A-Z equal a-z."""
        table = _LOWER if lower else _BYTE
        out = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(out):
            low = self.starts[at]
            upto = max(at + 1, int(np.searchsorted(self.ends, low + _BLOCK, "right")))
            size = int(self.ends[upto - 1] - low)
            _BYTES.reach(size)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(table[self.data[low : low + size]] * _BYTES.up[:size], out=sums[1:])
            start, end = self.starts[at:upto] - low, self.ends[at:upto] - low
            out[at:upto] = (sums[end] - sums[start]) * _BYTES.down[start] + (
                end - start
            ).astype(np.uint64)
            at = upto
        return mix(out)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` words; runs across texts are the caller's to skip."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, size):
        out = out * np.uint64(_BASE) + hashes[j : j + n]
    return mix(out)


def long_grams(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every run of `size` words, at a cost free of `size`."""
    n, lanes = len(hashes) - size + 1, []
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for salt, powers in enumerate(_LANES):
        powers.reach(len(hashes))
        sums = np.zeros(len(hashes) + 1, np.uint64)
        salted = mix(hashes + np.uint64(salt)) if salt else hashes
        np.cumsum(salted * powers.up[: len(hashes)], out=sums[1:])
        lanes.append(mix((sums[size:] - sums[:-size]) * powers.down[:n]))
    return lanes[0], lanes[1]


def digest(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a sequence of words."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's BIGINT."""
    return x.view(np.int64)
