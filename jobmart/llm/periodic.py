"""Periodic runs of words: stretches that repeat the same words with one period, over and over.

A run of period q has at least ``LEAST`` words and ``TIMES`` periods, so each of its words occurs at least ``TIMES``
times in it. Words that occur less often in a segment of the text cannot be in a run and split the segment; the parts
are split again by their own counts, until nothing changes. Most texts leave no segment. In those left, words are
compared with the words one lag later, lag by lag.

Lags from ``WIDE`` on are compared at few places: a run of lag q has at least 2q equal places in a row, so one in any
2q - 7 of them starts eight equal words, which are compared as one number. Only where these agree, the words
themselves are compared, to both sides as far as they agree. Multiples of a run's period are passed by inside of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart.llm.words import numbered

#: The least words and the least periods of a run.
LEAST, TIMES = 24, 3
#: Lags from here on are compared at few places, by as many words at once.
WIDE = 8


@dataclass(frozen=True, order=True)
class Run:
    """Words ``start`` to ``start + length - 1`` repeat those ``period`` earlier."""

    start: int
    period: int
    length: int


def numbers(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)


def _stretches(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    """First and end of each unbroken stretch of true of at least that length."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    a, b = edges[::2], edges[1::2]
    return list(zip(a[b - a >= least].tolist(), b[b - a >= least].tolist(), strict=True))


def segments(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """Parts of at least ``least`` words in which each word occurs ``times`` times or more; all runs are inside of them."""
    found, open_ = [], [(0, len(ids))] if len(ids) >= least else []
    while open_:
        a, b = open_.pop()
        _, place, counts = np.unique(ids[a:b], return_inverse=True, return_counts=True)
        common = counts[place] >= times
        if common.all():
            found.append((a, b))
        else:
            open_ += [(a + x, a + y) for x, y in _stretches(common, least)]
    return sorted(found)


def _reach(ids: np.ndarray, lag: int, at: int, end: int) -> tuple[int, int]:
    """The stretch around ``at`` where words equal those one lag later, below ``end``."""
    low, high, step = at, at + 1, 16
    while high < end:  # upwards, in growing steps
        same = ids[high : min(end, high + step)] == ids[high + lag : min(end, high + step) + lag]
        n = len(same) if same.all() else int(same.argmin())
        high, step = high + n, step * 2
        if n < len(same):
            break
    step = 16
    while low > 0:
        first = max(0, low - step)
        same = (ids[first:low] == ids[first + lag : low + lag])[::-1]
        n = len(same) if same.all() else int(same.argmin())
        low, step = low - n, step * 2
        if n < len(same):
            break
    return low, high


def _lag_scan(ids: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(first, end, lag) of each greatest stretch of words that equal those one lag before, by ascending lag."""
    n = len(ids)
    # The first run found over each word: two words inside of it, a multiple of its period apart, are no news.
    owner, ends, periods = np.full(n, -1), np.array([n]), np.array([n])

    def note(a: int, end: int, lag: int) -> None:
        nonlocal ends, periods
        owner[a:end] = np.where(owner[a:end] < 0, len(ends), owner[a:end])
        ends, periods = np.append(ends, end), np.append(periods, lag)

    for lag in range(1, min(WIDE - 1, n // times) + 1):
        for a, b in _stretches(ids[:-lag] == ids[lag:], max(least, times * lag) - lag):
            note(a, b + lag, lag)
            yield a, b + lag, lag
    if n // times < WIDE:
        return
    wide = np.zeros(n - WIDE + 1, dtype=np.uint64)
    for k in range(WIDE):
        wide += numbered(ids[k : n - WIDE + 1 + k].astype(np.uint64), k)
    for lag in range(WIDE, n // times + 1):
        equal = max(least, times * lag) - lag  # places in a row
        step = equal - WIDE + 1
        met = np.flatnonzero(wide[: len(wide) - lag : step] == wide[lag::step]) * step
        if len(met):
            of = owner[met]
            met = met[(of < 0) | (lag % periods[of] != 0) | (met + lag >= ends[of])]
        passed = -1
        for at in met.tolist():
            if at < passed:
                continue
            if ids[at] == ids[at + lag]:
                a, b = _reach(ids, lag, at, n - lag)
                passed = b
                if b - a >= equal:
                    note(a, b + lag, lag)
                    yield a, b + lag, lag


def runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs, by start and then period. ``times`` is 3 or more.

    A stretch with a period also has its multiples; as ``times`` is above 2 any two periods of it are multiples of its
    smallest one, and the greatest stretch is the same for all, so the first lag found for a stretch is its period.
    """
    found = []
    for a, b in segments(ids, least, times):
        periods: dict[tuple[int, int], int] = {}
        for x, y, lag in _lag_scan(ids[a:b], least, times):
            periods.setdefault((x, y), lag)
        found += [Run(a + x, lag, y - x) for (x, y), lag in periods.items()]
    return sorted(found)


def strongest(found: list[Run]) -> Run | None:
    """The run with the most periods; of equal ones the first, then the one of the smaller period."""
    best = None
    for run in found:
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


def repeated(found: list[Run], n: int) -> np.ndarray:
    """Whether each of ``n`` words repeats a run's first period."""
    gone = np.zeros(n, dtype=bool)
    for run in found:
        gone[run.start + run.period : run.start + run.length] = True
    return gone


def collapse(text: Column, least: int = LEAST, times: int = TIMES) -> Column:
    """A struct of the runs of a text's words and of the text without their repetitions.

    ``n_words``, ``n_runs``; ``start``, ``length`` and ``period`` of the run with the most periods, null without any;
    ``runs``, a line of start, length and period for each; and ``collapsed``, the words that stay, joined by a space.
    Words are separated by spaces and ASCII control characters 9 to 13. Null and empty texts have no words.
    """

    @F.pandas_udf("n_words long, n_runs long, start long, length long, period long, runs string, collapsed string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch:
                words = (value or b"").split()  # of bytes: at these separators alone
                found = runs(numbers(words), least, times)
                best = strongest(found)
                if found:
                    words_left = [w for w, gone in zip(words, repeated(found, len(words)).tolist(), strict=True) if not gone]
                else:
                    words_left = words
                lines = "".join(f"{r.start},{r.length},{r.period}\n" for r in found)
                place = (best.start, best.length, best.period) if best else (None,) * 3
                out.append((len(words), len(found), *place, lines, b" ".join(words_left).decode("utf-8", "replace")))
            table = pd.DataFrame(out, columns=["n_words", "n_runs", "start", "length", "period", "runs", "collapsed"])
            yield table.astype({c: "Int64" for c in ("start", "length", "period")})

    return run(text.cast("binary"))


def collapse_text(docs, text: str = "text", least: int = LEAST, times: int = TIMES):
    """``docs`` with the columns of ``collapse``; columns of these names are replaced. Other rows and columns stay.

    Rows that repeat are each worked on by themselves, and nothing is shuffled.
    """
    names = ["n_words", "n_runs", "start", "length", "period", "runs", "collapsed"]
    old = docs.drop(*[n for n in names if n != text])
    return docs.select(*old.columns, collapse(F.col(text), least, times).alias("_found")).select(*old.columns, "_found.*")


def planted(text: Column, doc_id: Column) -> Column:
    """Texts, one in ten with a periodic end instead of its own, by a checksum of the id.

    With h the checksum, one that ten divides, and g = h // 10, a text of n words repeats from word a = g % n on with
    the period 1 + (n - a) // (3 + g % 8). Null ids and texts without words stay as they are.
    """
    checksum = F.crc32(doc_id.cast("string").cast("binary"))

    @F.pandas_udf("binary")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, checks in batches:
            out = []
            for value, h in zip(texts, checks, strict=True):
                words = (value or b"").split() if h >= 0 and h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    value = b" ".join(words[:a] + [words[a + (i - a) % p] for i in range(a, n)])
                out.append(value)
            yield pd.Series(out, dtype=object)

    return run(text.cast("binary"), F.coalesce(checksum, F.lit(-1)))
