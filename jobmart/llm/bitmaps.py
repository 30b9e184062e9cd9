"""Compressed bitmaps of numbers, with popcount directories that give a number's rank without sorting.

A number's upper bits name its container, its ``LOW_BITS`` lower ones a bit in it. A container is kept in the smallest
of three forms: the bits themselves, a list of the set ones, or a list of their unbroken stretches. Numbers that occur
more than once are listed beside the bits with how often they occur again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

LOW_BITS = 12
SIZE = 1 << LOW_BITS
_WORD = 64
_BITS, _LIST, _STRETCHES = b"B", b"L", b"S"
_MORE = np.dtype([("low", "<u2"), ("more", "<i8")])


@dataclass(frozen=True)
class Container:
    """``words`` holds the bits, ``low`` the ascending numbers that occur again and ``more`` how often they do."""

    words: np.ndarray
    low: np.ndarray
    more: np.ndarray

    @classmethod
    def of(cls, lows: np.ndarray, times: np.ndarray) -> Container:
        """Of lower bits and how often each is meant; a number may be given several times."""
        counts = np.zeros(SIZE, dtype=np.int64)
        np.add.at(counts, lows, times)
        return cls._counted(counts)

    @classmethod
    def _counted(cls, counts: np.ndarray) -> Container:
        words = np.packbits(counts > 0, bitorder="little").view("<u8")
        again = np.flatnonzero(counts > 1)
        return cls(words, again, counts[again] - 1)

    def _counts(self) -> np.ndarray:
        counts = np.unpackbits(self.words.view(np.uint8), bitorder="little").astype(np.int64)
        counts[self.low] += self.more
        return counts

    @classmethod
    def merged(cls, parts: list[Container]) -> Container:
        return cls._counted(sum(p._counts() for p in parts))

    def __len__(self) -> int:
        return int(np.bitwise_count(self.words).sum()) + int(self.more.sum())

    @cached_property
    def directory(self) -> np.ndarray:
        """For each word of bits, how many are set before it."""
        counts = np.bitwise_count(self.words).astype(np.int64)
        return np.cumsum(counts) - counts

    def rank(self, lows: np.ndarray) -> np.ndarray:
        """How many numbers of the container, repetitions counted, are below each."""
        word, bit = lows // _WORD, (lows % _WORD).astype(np.uint64)
        before = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        again = np.concatenate([[0], np.cumsum(self.more)])
        return self.directory[word] + np.bitwise_count(before) + again[np.searchsorted(self.low, lows)]

    def pack(self) -> bytes:
        bits = np.unpackbits(self.words.view(np.uint8), bitorder="little")
        edges = np.flatnonzero(np.diff(np.concatenate([[0], bits, [0]]).astype(np.int8))).astype("<u2")
        forms = [
            (_BITS, self.words.tobytes()), (_LIST, np.flatnonzero(bits).astype("<u2").tobytes()),
            (_STRETCHES, edges.tobytes()),
        ]
        name, body = min(forms, key=lambda f: len(f[1]))
        more = np.zeros(len(self.low), dtype=_MORE)
        more["low"], more["more"] = self.low, self.more
        return name + len(body).to_bytes(2, "little") + body + more.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> Container:
        name, size = data[:1], int.from_bytes(data[1:3], "little")
        body, more = data[3 : 3 + size], np.frombuffer(data[3 + size :], dtype=_MORE)
        if name == _BITS:
            words = np.frombuffer(body, dtype="<u8")
        else:
            at, bits = np.frombuffer(body, dtype="<u2").astype(np.int64), np.zeros(SIZE + 1, dtype=np.int8)
            if name == _LIST:
                bits[at] = 1
            else:
                bits[at[::2]] += 1
                bits[at[1::2]] -= 1
                bits = np.cumsum(bits)
            words = np.packbits(bits[:SIZE].astype(bool), bitorder="little").view("<u8")
        return cls(words, more["low"].astype(np.int64), more["more"].astype(np.int64))
