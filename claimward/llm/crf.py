"""Linear-chain conditional random field over many short sequences at once.

Sequences lie one behind the other in flat arrays. Forward and backward passes go through
all sequences in step, longest first, so that a step is one small matrix product over the
sequences that are still running. Probabilities are rescaled at every step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Weights of transitions (from, to) and of the first label."""

    moves: np.ndarray
    first: np.ndarray

    @classmethod
    def blank(cls, labels: int) -> "Chain":
        return cls(np.zeros((labels, labels)), np.zeros(labels))

    def marginals(self, scores: np.ndarray, starts: np.ndarray, pairs: bool = False):
        """Label probabilities of every element, and with ``pairs`` the summed
        probabilities of label pairs and of first labels.

        ``scores``: one row per element, one column per label; ``starts``: where each
        sequence begins, with the total as last entry.
        """
        n, labels = scores.shape
        sizes = np.diff(starts)
        order = np.argsort(-sizes, kind="stable")
        begin, sizes = starts[:-1][order], sizes[order]
        running = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
        local = np.exp(scores - scores.max(1, keepdims=True)) if n else scores
        moves, first = np.exp(self.moves), np.exp(self.first - self.first.max())
        ahead = np.empty((n, labels))
        state = None
        for t, count in enumerate(running):
            at = begin[:count] + t
            state = local[at] * (first if t == 0 else state[:count] @ moves)
            state /= state.sum(1, keepdims=True)
            ahead[at] = state
        both = np.empty((n, labels))
        pair_sum = np.zeros((labels, labels))
        later = np.zeros((0, labels))
        for t in range(len(running) - 1, -1, -1):
            count = running[t]
            at = begin[:count] + t
            here = ahead[at]
            if len(later) < count:
                later = np.concatenate([later, np.ones((count - len(later), labels))])
            prob = here * later
            prob /= prob.sum(1, keepdims=True)
            both[at] = prob
            onward = local[at] * later
            if t:
                before = ahead[at - 1]
                if pairs:
                    weight = ((before @ moves) * onward).sum(1, keepdims=True)
                    pair_sum += (before.T @ (onward / weight)) * moves
                later = onward @ moves.T
                later /= later.sum(1, keepdims=True)
        if not pairs:
            return both
        return both, pair_sum, both[starts[:-1][np.diff(starts) > 0]].sum(0)


def fit(
    features: np.ndarray,
    owner: np.ndarray,
    kinds: np.ndarray,
    gold: np.ndarray,
    starts: np.ndarray,
    labels: int,
    buckets: int,
    rounds: int = 30,
    rate: float = 0.3,
    penalty: float = 1e-5,
) -> tuple[np.ndarray, Chain]:
    """Weights (bucket, label) and transitions by gradient ascent with adaptive steps.

    Elements have a kind (``kinds``), and ``owner`` names the kind of every feature.
    ``gold`` are the labels of the elements.
    """
    n, n_kinds = len(kinds), int(kinds.max()) + 1
    table, chain = np.zeros((buckets, labels)), Chain.blank(labels)
    wanted = np.zeros((n, labels))
    wanted[np.arange(n), gold] = 1
    inner = np.ones(n, bool)
    inner[starts[:-1][np.diff(starts) > 0]] = False
    after = np.flatnonzero(inner)
    pairs_wanted = np.zeros((labels, labels))
    np.add.at(pairs_wanted, (gold[after - 1], gold[after]), 1)
    first_wanted = wanted[~inner].sum(0)
    scale = 1.0 / max(n, 1)
    parameters = [table, chain.moves, chain.first]
    means = [np.zeros_like(p) for p in parameters]
    squares = [np.zeros_like(p) for p in parameters]
    for step in range(1, rounds + 1):
        scores = kind_scores(table, features, owner, n_kinds)[kinds]
        prob, pair_sum, first_sum = chain.marginals(scores, starts, pairs=True)
        miss = wanted - prob
        by_label = []
        for label in range(labels):
            by_kind = np.bincount(kinds, miss[:, label], minlength=n_kinds)
            by_label.append(np.bincount(features, by_kind[owner], minlength=buckets))
        slopes = [
            np.stack(by_label, 1) * scale - penalty * table,
            (pairs_wanted - pair_sum) * scale - penalty * chain.moves,
            (first_wanted - first_sum) * scale - penalty * chain.first,
        ]
        for p, slope, m, s in zip(parameters, slopes, means, squares):
            m += 0.1 * (slope - m)
            s += 0.01 * (slope * slope - s)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return table, chain


def kind_scores(table: np.ndarray, features: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Sum of the weights of every kind's features."""
    columns = [np.bincount(owner, column[features], minlength=count) for column in np.ascontiguousarray(table.T)]
    return np.stack(columns, 1)
