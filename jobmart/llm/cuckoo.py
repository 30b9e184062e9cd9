"""A cuckoo filter over 128-bit digests: membership without false negatives, with deletion."""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

SLOTS = 4
KICKS = 400
_MIX = 0x5BD1E995


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; what finds no room is kept apart, so nothing is ever lost.

    A key must be added once and removed once. A key never added may test positive, at a rate near 8 in 65,536.
    """

    def __init__(self, keys: int = 0, table: np.ndarray | None = None, apart: Iterable[tuple[int, int]] = ()):
        if table is None:
            buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.85)))))
            table = np.zeros((buckets, SLOTS), dtype=np.uint16)
        self.table, self.apart = table, list(apart)

    @staticmethod
    def halves(digests: Iterable[bytes]) -> np.ndarray:
        """Digests of 16 bytes as rows of two unsigned numbers."""
        return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)

    def _places(self, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        print_ = (halves[:, 1] % np.uint64(65_535)).astype(np.uint16) + np.uint16(1)
        first = (halves[:, 0] & mask).astype(np.int64)
        return print_, first, first ^ self._step(print_)

    def _step(self, print_: np.ndarray) -> np.ndarray:
        return (print_.astype(np.int64) * _MIX) & (len(self.table) - 1)

    def contains(self, halves: np.ndarray) -> np.ndarray:
        print_, first, second = self._places(halves)
        found = (self.table[first] == print_[:, None]).any(1) | (self.table[second] == print_[:, None]).any(1)
        for p, b in self.apart:
            found |= (print_ == p) & ((first == b) | (second == b))
        return found

    def add(self, halves: np.ndarray) -> None:
        for p, a, b in zip(*self._places(halves), strict=True):
            self._put(int(p), int(a), int(b))

    def _put(self, p: int, a: int, b: int) -> None:
        for bucket in (a, b):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = p
                return
        bucket = a
        for kick in range(KICKS):
            slot = (kick * 7 + p) % SLOTS
            p, self.table[bucket, slot] = int(self.table[bucket, slot]), p
            bucket ^= (p * _MIX) & (len(self.table) - 1)
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = p
                return
        self.apart.append((p, bucket))

    def remove(self, halves: np.ndarray) -> None:
        for p, a, b in zip(*self._places(halves), strict=True):
            p, a, b = int(p), int(a), int(b)
            for bucket in (a, b):
                here = np.flatnonzero(self.table[bucket] == p)
                if len(here):
                    self.table[bucket, here[0]] = 0
                    break
            else:
                self.apart = self._without(p, a, b)

    def _without(self, p: int, a: int, b: int) -> list[tuple[int, int]]:
        for i, (q, bucket) in enumerate(self.apart):
            if q == p and bucket in (a, b):
                return self.apart[:i] + self.apart[i + 1 :]
        return self.apart

    def to_bytes(self) -> bytes:
        apart = b"".join(struct.pack("<HQ", p, b) for p, b in self.apart)
        return struct.pack("<QQ", len(self.table), len(self.apart)) + self.table.astype("<u2").tobytes() + apart

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        buckets, apart = struct.unpack_from("<QQ", data)
        end = 16 + buckets * SLOTS * 2
        table = np.frombuffer(data[16:end], dtype="<u2").reshape(-1, SLOTS).astype(np.uint16)
        return cls(table=table, apart=[struct.unpack_from("<HQ", data, end + 10 * i) for i in range(apart)])
