"""Words of a text as numbers: positions and 64-bit hashes, worked out on the text's bytes with whole-array operations.

Words are runs of anything but the separators; every separator is one ASCII byte, so UTF-8 needs no decoding.
"""

from __future__ import annotations

import numpy as np

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[32, *range(9, 14)]] = True

_BLOCK = 1 << 14


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers of 64-bit numbers, one to one (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(x: np.ndarray, number: int) -> np.ndarray:
    """A different hash of the same numbers for each ``number``."""
    return mixed(x + np.uint64((number * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, _BLOCK + 1)
_DOWN = _powers(pow(_BASE, -1, 2**64), _BLOCK + 1)


def bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~SEPARATOR[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, by differences of running sums over blocks of bounded size."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        origin = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, origin + _BLOCK, side="right")))
        size = int(ends[j - 1] - origin)
        if size > _BLOCK:  # one very long word
            up = _powers(_BASE, size)
            out[i] = (_BYTE[data[origin : origin + size]] * up).sum(dtype=np.uint64)
        else:
            sums = np.zeros(size + 1, dtype=np.uint64)
            np.cumsum(_BYTE[data[origin : origin + size]] * _UP[:size], out=sums[1:])
            a, b = starts[i:j] - origin, ends[i:j] - origin
            out[i:j] = (sums[b] - sums[a]) * _DOWN[a]
        i = j
    return mixed(out + (ends - starts).astype(np.uint64))


def windows(hashed: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words; empty if there are fewer words."""
    n = len(hashed) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out += numbered(hashed[k : k + n], k)
    return mixed(out)


def as_bytes(value: bytes | None) -> np.ndarray:
    return np.frombuffer(value or b"", dtype=np.uint8)
