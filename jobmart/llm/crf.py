"""A linear-chain conditional random field over three tags, for short sequences of indexed features."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
TAGS = 3
_NEVER = -1e4
#: Inside never follows outside.
_ALLOWED = np.array([[0.0, 0.0, _NEVER], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]])


@dataclass(frozen=True)
class Field:
    """``index`` numbers the known features, ``emit`` has a row of tag weights for each, ``move`` the transitions."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray

    def tags(self, sequence: Iterable[list[str]]) -> list[int]:
        """The best tags by Viterbi; the tokens before and after the sequence are outside."""
        rows = [self.emit[[i for f in features if (i := self.index.get(f)) is not None]].sum(0) for features in sequence]
        return self.best(rows)

    def gains(self, scores: np.ndarray) -> list[float]:
        """By how much the best tags with 1, 2, ... tokens in secrets beat those with none; the last is for all tokens."""
        move = self.move + _ALLOWED
        n = len(scores)
        # best[k, tag]: of the tokens so far, k of them in secrets.
        best = np.full((n + 1, TAGS), -np.inf)
        best[0, OUTSIDE] = 0.0
        for row in scores:
            ways = (best[:, :, None] + move).max(1) + row
            best = np.full_like(best, -np.inf)
            best[:, OUTSIDE] = ways[:, OUTSIDE]
            best[1:, BEGIN], best[1:, INSIDE] = ways[:-1, BEGIN], ways[:-1, INSIDE]
        ended = (best + move[:, OUTSIDE]).max(1)
        return (ended[1:] - ended[0]).tolist()

    def best(self, rows: np.ndarray | list[np.ndarray]) -> list[int]:
        """The best tags by Viterbi, of the tokens' scores for each tag."""
        move = self.move + _ALLOWED
        best, back = rows[0] + move[OUTSIDE], []
        for row in rows[1:]:
            ways = best[:, None] + move
            back.append(ways.argmax(0))
            best = ways.max(0) + row
        tag = int((best + move[:, OUTSIDE]).argmax())
        found = [tag]
        for step in reversed(back):
            tag = int(step[tag])
            found.append(tag)
        return found[::-1]


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(
    sequences: list[tuple[list[list[str]], list[int]]], steps: int = 150, rate: float = 0.4, penalty: float = 3e-4,
    min_count: int = 2,
) -> Field | None:
    """Weights by adaptive gradient steps on the penalised log-likelihood; None without any tagged token.

    All sequences are worked on together, the longest first, so that those that reach a place are the first ones.
    """
    sequences = sorted(sequences, key=lambda x: -len(x[1]))
    if not any(t != OUTSIDE for _, tags in sequences for t in tags):
        return None
    counts: dict[str, int] = {}
    for tokens, _ in sequences:
        for features in tokens:
            for f in features:
                counts[f] = counts.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= min_count))}
    n, longest = len(sequences), max(len(t) for _, t in sequences)
    live = np.zeros((n, longest), dtype=bool)
    gold = np.zeros((n, longest), dtype=np.int64)
    at, feature = [], []
    for s, (tokens, tags) in enumerate(sequences):
        live[s, : len(tags)] = True
        gold[s, : len(tags)] = tags
        for t, features in enumerate(tokens):
            known = [index[f] for f in features if f in index]
            at += [s * longest + t] * len(known)
            feature += known
    at, feature = np.array(at), np.array(feature)
    lengths = live.sum(1)
    reach = live.sum(0)  # sequences that have a token at each place
    emit, move = np.zeros((len(index), TAGS)), np.zeros((TAGS, TAGS))
    seen_emit, seen_move = np.full_like(emit, 1e-8), np.full_like(move, 1e-8)
    every = np.arange(n)

    def expected(scores: np.ndarray, ways: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each token's tags, and the expected number of each transition."""
        forward = np.zeros((n, longest, TAGS))
        forward[:, 0] = scores[:, 0] + ways[OUTSIDE]
        for t in range(1, longest):
            k = reach[t]
            forward[:k, t] = _logsum(forward[:k, t - 1, :, None] + ways, 1) + scores[:k, t]
        backward = np.zeros((n, longest, TAGS))
        backward[:, :] = ways[:, OUTSIDE]
        for t in range(longest - 2, -1, -1):
            k = reach[t + 1]
            backward[:k, t] = _logsum(ways + (scores[:k, t + 1] + backward[:k, t + 1])[:, None, :], 2)
        total = _logsum(forward[every, lengths - 1] + ways[:, OUTSIDE], 1)
        single = np.exp(forward + backward - total[:, None, None]) * live[:, :, None]
        moves = np.zeros((TAGS, TAGS))
        moves[OUTSIDE] += single[:, 0].sum(0)
        for t in range(1, longest):
            k = reach[t]
            pair = forward[:k, t - 1, :, None] + ways + (scores[:k, t] + backward[:k, t])[:, None, :]
            moves += np.exp(pair - total[:k, None, None]).sum(0)
        moves[:, OUTSIDE] += single[every, lengths - 1].sum(0)
        return single, moves

    true_moves = np.zeros((TAGS, TAGS))
    np.add.at(true_moves, (OUTSIDE, gold[:, 0]), 1)
    for t in range(1, longest):
        on = live[:, t]
        np.add.at(true_moves, (gold[on, t - 1], gold[on, t]), 1)
    np.add.at(true_moves, (gold[every, lengths - 1], OUTSIDE), 1)
    truth = np.eye(TAGS)[gold] * live[:, :, None]

    for _ in range(steps):
        scores = np.column_stack([np.bincount(at, emit[feature, k], n * longest) for k in range(TAGS)])
        single, moves = expected(scores.reshape(n, longest, TAGS), move + _ALLOWED)
        off = (single - truth).reshape(-1, TAGS)
        slope = np.column_stack([np.bincount(feature, off[at, k], len(index)) for k in range(TAGS)]) / n + penalty * emit
        turn = (moves - true_moves) / n * (_ALLOWED == 0) + penalty * move
        seen_emit += slope**2
        seen_move += turn**2
        emit -= rate * slope / np.sqrt(seen_emit)
        move -= rate * turn / np.sqrt(seen_move)
    return Field(index, emit.astype(np.float32), move)
