"""DartMinHash: signatures of weighted sets whose agreement estimates weighted Jaccard similarity.

Darts fall on the plane of weight and rank of every element, at random but always at the same places. A set is hit by
the darts below its weights. Each dart belongs to one coordinate of the signature, and each coordinate keeps the dart
of lowest rank. The ranks are searched upwards in cells, only as far as the emptiest coordinate needs, so the work is
proportional to the set's size plus the signature's, not to their product.
"""

from __future__ import annotations

import numpy as np

from jobmart.llm.words import mixed, numbered

#: Cells of rank below 1; from there on every cell is one wide.
_EDGES = np.array([0, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 1.0])


def _poisson_table(mean: float) -> np.ndarray:
    p, out, k = np.exp(-mean), [], 0
    while not out or (p > 1e-18 and len(out) < 40):
        out.append(p)
        k += 1
        p *= mean / k
    return np.cumsum(out)


_TABLES = {w: _poisson_table(w) for w in (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1.0)}


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) / 2**53


def _cell(number: int) -> tuple[float, float]:
    """Lower edge and width of a cell of ranks."""
    inner = len(_EDGES) - 1
    if number < inner:
        return float(_EDGES[number]), float(_EDGES[number + 1] - _EDGES[number])
    return 1.0 + number - inner, 1.0


def signature(elements: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit number per coordinate. Elements are distinct 64-bit hashes, weights positive; not empty.

    Weights count in units: a weight well below 1 makes an element's darts rare, so weights should be scaled
    to a mean near 1 or above.
    """
    whole = np.ceil(weights).astype(np.int64)
    owner = np.repeat(np.arange(len(elements)), whole)
    copy = np.arange(len(owner)) - np.repeat(np.cumsum(whole) - whole, whole)
    base = mixed(elements[owner] + mixed(copy.astype(np.uint64) + np.uint64(0x51ED27)))
    room = weights[owner] - copy  # how much of this unit of weight the element has
    partial = bool((room < 1).any())

    wanted = size * (np.log(size) + 2) / weights.sum()
    rank, found = np.full(size, np.inf), np.zeros(size, dtype=np.uint64)
    first = 0
    while True:
        last = first
        while _cell(last)[0] + _cell(last)[1] < wanted and (last - first + 2) * len(base) <= 1 << 18:
            last += 1
        parts = []
        cells = [[c] for c in range(first, min(last + 1, len(_EDGES) - 1))]
        cells.append(list(range(max(first, len(_EDGES) - 1), last + 1)))
        for group in filter(None, cells):  # the wide cells are alike and searched together
            lows, width = np.array([_cell(c)[0] for c in group]), _cell(group[0])[1]
            seeds = mixed(base[None, :] + mixed(np.array(group, dtype=np.uint64) + np.uint64(0xA5A5))[:, None]).ravel()
            counts = np.searchsorted(_TABLES[width], _uniform(seeds), side="right")
            at = np.flatnonzero(counts)
            counts = counts[at]
            many = np.repeat(at, counts)
            nth = np.arange(len(many)) - np.repeat(np.cumsum(counts) - counts, counts)
            dart = numbered(seeds[many] + nth.astype(np.uint64), 1)
            if partial:
                inside = _uniform(numbered(dart, 2)) < room[many % len(base)]
                dart, many = dart[inside], many[inside]
            parts.append((dart, lows[many // len(base)] + width * _uniform(numbered(dart, 3))))
        darts, ranks = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(ranks, kind="stable")
        place, index = np.unique((darts[order] % np.uint64(size)).astype(np.int64), return_index=True)
        better = ranks[order][index] < rank[place]
        place, index = place[better], index[better]
        rank[place], found[place] = ranks[order][index], darts[order][index]
        if np.isfinite(rank).all():
            return found
        first, wanted = last + 1, max(wanted * 1.25, _cell(last + 1)[0] + 1e-9)


def bands(found: np.ndarray, rows: int) -> np.ndarray:
    """A hash per band of ``rows`` coordinates; equal bands of different numbers have different hashes."""
    table = found.reshape(-1, rows)
    out = np.zeros(len(table), dtype=np.uint64)
    for k in range(rows):
        out += numbered(table[:, k], 10 + k)
    return mixed(out + mixed(np.arange(len(table), dtype=np.uint64) + np.uint64(77)))
