"""A bidirectional gated recurrent network with attention pooling, over windows of words; trained and run in numpy.

A word's input is the vector of the word itself, if it was seen often enough, and the vectors of its runs of
characters. Both directions read a window, attention weighs their states, and the weighted state gives the window's
logit. Work is on many windows at once, step by step; a position after the window's end leaves the state as it is.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Sizes: state of one direction, vectors of words and of character runs, attention.
HIDDEN, VECTOR, ATTENTION = 8, 8, 8
_GATES = 3 * HIDDEN
#: An update gate so far open that the state stays.
_STAY = 40.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Inputs:
    """Distinct words: the row of ``word`` vectors of each, its runs of characters, and where those of each begin."""

    rows: np.ndarray
    grams: np.ndarray
    starts: np.ndarray

    def __post_init__(self):
        self.counts = np.diff(np.append(self.starts, len(self.grams)))
        self.scale = (1 / np.sqrt(np.maximum(self.counts, 1))).astype(np.float32)


@dataclass
class Network:
    weights: dict[str, np.ndarray]
    _kept: dict = field(default_factory=dict, repr=False)

    @classmethod
    def new(cls, n_words: int, n_grams: int, seed: int = 11) -> Network:
        draw = np.random.default_rng(seed)

        def at_random(*shape: int) -> np.ndarray:
            return (draw.normal(size=shape) / np.sqrt(shape[-2])).astype(np.float32)

        bias = np.zeros(2 * _GATES, dtype=np.float32)
        return cls({
            # The last word row is for all words that have none of their own.
            "word": np.zeros((n_words + 1, VECTOR), dtype=np.float32), "gram": np.zeros((n_grams, VECTOR), dtype=np.float32),
            "into": at_random(2 * VECTOR, 2 * _GATES), "bias": bias, "again": at_random(2, HIDDEN, _GATES),
            "look": at_random(2 * HIDDEN, ATTENTION), "look_bias": np.zeros(ATTENTION, dtype=np.float32),
            "mark": at_random(ATTENTION, 1)[:, 0], "out": at_random(2 * HIDDEN, 1)[:, 0],
            "out_bias": np.full(1, -2.0, dtype=np.float32),
        })

    def _vectors(self, words: Inputs) -> np.ndarray:
        w = self.weights
        found = np.zeros((len(words.rows), 2 * VECTOR), dtype=np.float32)
        found[:, :VECTOR] = w["word"][words.rows]
        if len(words.grams):
            some = words.counts > 0
            found[some, VECTOR:] = np.add.reduceat(w["gram"][words.grams], words.starts[some]) * words.scale[some, None]
        return found

    def _gate_inputs(self, vectors: np.ndarray) -> np.ndarray:
        """Of each distinct word for both directions, and of the empty position as the last row."""
        table = np.zeros((2, len(vectors) + 1, _GATES), dtype=np.float32)
        both = vectors @ self.weights["into"] + self.weights["bias"]
        table[0, :-1], table[1, :-1] = both[:, :_GATES], both[:, _GATES:]
        table[:, -1, :HIDDEN] = _STAY
        return table

    def logits(self, words: Inputs, windows: np.ndarray, block: int = 2_048) -> np.ndarray:
        """Of windows, rows of numbers of distinct words; -1 is an empty position."""
        if not len(windows):
            return np.empty(0, dtype=np.float32)
        table = self._gate_inputs(self._vectors(words))
        return np.concatenate([self._forward(table, windows[i : i + block])[0] for i in range(0, len(windows), block)])

    def _forward(self, table: np.ndarray, windows: np.ndarray, keep: bool = False):
        w, (n, steps) = self.weights, windows.shape
        states = np.zeros((steps, n, 2 * HIDDEN), dtype=np.float32)
        kept: list[dict[int, tuple]] = [{}, {}]
        for way in (0, 1):
            state, again = np.zeros((n, HIDDEN), dtype=np.float32), w["again"][way]
            for t in range(steps) if way == 0 else reversed(range(steps)):
                x, g = np.take(table[way], windows[:, t], axis=0), state @ again
                gates = _sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
                if keep:
                    kept[way][t] = state, z, r, new, g[:, 2 * HIDDEN :]
                state = new + z * (state - new)
                states[t, :, way * HIDDEN : (way + 1) * HIDDEN] = state
        live = (windows >= 0).T
        looks = np.tanh(states @ w["look"] + w["look_bias"])
        marks = np.where(live, looks @ w["mark"], -1e9)
        share = np.exp(marks - marks.max(0)) * live
        share /= np.maximum(share.sum(0), 1e-9)
        context = np.einsum("tn,tnh->nh", share, states)
        logits = context @ w["out"] + w["out_bias"][0]
        return logits, (states, kept, looks, share, context)

    def gradients(self, words: Inputs, windows: np.ndarray, loss_slope) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """The logits of the windows, and the slopes of all weights; ``loss_slope`` gives the loss's slope at the logits."""
        w, (n, steps) = self.weights, windows.shape
        vectors = self._vectors(words)
        logits, (states, kept, looks, share, context) = self._forward(self._gate_inputs(vectors), windows, keep=True)
        d = loss_slope(logits).astype(np.float32)
        found = {"out": context.T @ d, "out_bias": d.sum(keepdims=True)}
        d_context = d[:, None] * w["out"]
        d_states = share[:, :, None] * d_context
        d_share = np.einsum("nh,tnh->tn", d_context, states)
        d_marks = share * (d_share - (share * d_share).sum(0))
        found["mark"] = np.einsum("tn,tna->a", d_marks, looks)
        d_looks = d_marks[:, :, None] * w["mark"] * (1 - looks**2)
        found["look"], found["look_bias"] = np.einsum("tnh,tna->ha", states, d_looks, optimize=True), d_looks.sum((0, 1))
        d_states += d_looks @ w["look"].T
        d_gates = np.zeros((n, steps, 2 * _GATES), dtype=np.float32)
        found["again"] = np.zeros_like(w["again"])
        for way in (0, 1):
            carried, again = np.zeros((n, HIDDEN), dtype=np.float32), w["again"][way]
            for t in reversed(range(steps)) if way == 0 else range(steps):
                state, z, r, new, g = kept[way][t]
                d_state = carried + d_states[t, :, way * HIDDEN : (way + 1) * HIDDEN]
                d_new = d_state * (1 - z) * (1 - new**2)
                d_z, d_r = d_state * (state - new) * z * (1 - z), d_new * g * r * (1 - r)
                own = np.concatenate([d_z, d_r, d_new * r], axis=1)
                carried = d_state * z + own @ again.T
                found["again"][way] += state.T @ own
                d_gates[:, t, way * _GATES : (way + 1) * _GATES] = np.concatenate([d_z, d_r, d_new], axis=1)
        flat, d_flat = windows.ravel(), d_gates.reshape(-1, 2 * _GATES)
        order = np.argsort(flat, kind="stable")
        order = order[np.searchsorted(flat[order], 0) :]
        d_words = np.zeros((len(words.rows), 2 * _GATES), dtype=np.float32)
        if len(order):
            seen, first = np.unique(flat[order], return_index=True)
            d_words[seen] = np.add.reduceat(d_flat[order], first)
        found["into"], found["bias"] = vectors.T @ d_words, d_words.sum(0)
        d_vectors = d_words @ w["into"].T
        found["word"] = _spread(d_vectors[:, :VECTOR], words.rows, len(w["word"]))
        d_grams = np.repeat(d_vectors[:, VECTOR:] * words.scale[:, None], words.counts, axis=0)
        found["gram"] = _spread(d_grams, words.grams, len(w["gram"]))
        found["word"][-1] = 0
        return logits, found


def _spread(values: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``values`` by row."""
    return np.column_stack([np.bincount(rows, values[:, k], size) for k in range(values.shape[1])]).astype(np.float32)


class Adam:
    """Steps of sizes that follow the slopes' own; weights shrink a little at each."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float = 0.02, shrink: float = 1e-3):
        self.weights, self.rate, self.shrink, self.n = weights, rate, shrink, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, slopes: dict[str, np.ndarray]) -> None:
        self.n += 1
        for k, slope in slopes.items():
            self.mean[k] += 0.1 * (slope - self.mean[k])
            self.square[k] += 0.01 * (slope**2 - self.square[k])
            ahead = self.mean[k] / (1 - 0.9**self.n)
            spread = np.sqrt(self.square[k] / (1 - 0.99**self.n)) + 1e-8
            self.weights[k] -= self.rate * (ahead / spread + self.shrink * self.weights[k])
