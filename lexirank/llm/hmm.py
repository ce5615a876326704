"""A hidden Markov model of class sequences: scaled recursions over many sequences at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Tokens whose state probabilities are held at a time.
CHUNK_TOKENS = 400_000


@dataclass
class Hmm:
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray  # classes x states

    @classmethod
    def begin(cls, share: np.ndarray, states: int, seed: int) -> Hmm:
        """Sticky states, each with the classes' shares perturbed at random."""
        rng = np.random.default_rng(seed)
        emits = share[:, None] * np.exp(rng.standard_normal((len(share), states)))
        moves = np.full((states, states), 0.1 / max(states - 1, 1))
        np.fill_diagonal(moves, 0.9 if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), moves, emits / emits.sum(0))

    @classmethod
    def of_counts(cls, start: np.ndarray, moves: np.ndarray, emits: np.ndarray, share: np.ndarray) -> Hmm:
        """The counts' frequencies, smoothed: emissions by the classes' shares, the rest by equal ones."""
        emits = emits + 10.0 * share[:, None]
        moves, start = moves + 1e-2, start + 1e-2
        return cls(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))

    def _chunks(self, flat: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Sequences, longest first, in chunks: which, observations by time, how many go on at each time, where each time begins."""
        n = np.diff(bounds)
        order = np.argsort(-n, kind="stable")
        order = order[: int((n > 0).sum())]
        i = 0
        while i < len(order):
            total = np.cumsum(n[order[i:]])
            j = i + max(1, int(np.searchsorted(total, CHUNK_TOKENS, side="right")))
            which = order[i:j]
            length = n[which]
            on = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
            at = np.concatenate([[0], np.cumsum(on)])
            doc = np.arange(at[-1]) - np.repeat(at[:-1], on)
            seen = flat[bounds[which][doc] + np.repeat(np.arange(length[0]), on)].astype(np.int64)
            yield which, seen, on, at
            i = j

    def _forward(self, emitted: np.ndarray, on: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        alpha, scale = np.empty_like(emitted), np.empty(len(emitted))
        now = self.start * emitted[: on[0]]
        for t in range(len(on)):
            if t:
                now = (now[: on[t]] @ self.moves) * emitted[at[t] : at[t + 1]]
            size = now.sum(1)
            now /= size[:, None]
            alpha[at[t] : at[t + 1]], scale[at[t] : at[t + 1]] = now, size
        return alpha, scale

    def log10(self, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The exact log10 likelihood of each sequence, by the scaled forward recursion; 0 of an empty one."""
        out = np.zeros(len(bounds) - 1)
        for which, seen, on, at in self._chunks(flat, bounds):
            _, scale = self._forward(self.emits[seen], on, at)
            doc = np.arange(at[-1]) - np.repeat(at[:-1], on)
            out[which] = np.bincount(doc, weights=np.log10(scale), minlength=len(which))
        return out

    def expect(self, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, moves and emissions over the sequences."""
        k = len(self.start)
        start, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros_like(self.emits)
        back = np.ascontiguousarray(self.moves.T)
        for _, seen, on, at in self._chunks(flat, bounds):
            emitted = self.emits[seen]
            alpha, scale = self._forward(emitted, on, at)
            emitted /= scale[:, None]
            pairs, beta = np.zeros((k, k)), np.ones((on[-1], k))
            for t in range(len(on) - 1, -1, -1):
                if t < len(on) - 1:
                    ahead = emitted[at[t + 1] : at[t + 2]] * beta
                    pairs += alpha[at[t] : at[t] + on[t + 1]].T @ ahead
                    beta = ahead @ back
                    if on[t] > on[t + 1]:
                        beta = np.concatenate([beta, np.ones((on[t] - on[t + 1], k))])
                alpha[at[t] : at[t + 1]] *= beta
            moves += pairs * self.moves
            start += alpha[: on[0]].sum(0)
            for s in range(k):
                emits[:, s] += np.bincount(seen, weights=alpha[:, s], minlength=len(emits))
        return start, moves, emits
