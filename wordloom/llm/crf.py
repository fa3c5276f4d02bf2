"""Linear-chain conditional random field with two labels and hashed binary features."""

from __future__ import annotations

from zlib import crc32

import numpy as np

DIMENSIONS = 1 << 14
CHAIN = 300  # blocks of a page that are fitted in a row


def hashed(name: str) -> int:
    return 1 + crc32(name.encode()) % (DIMENSIONS - 1)  # 0 pads


def padded(rows: list[list[int]]) -> np.ndarray:
    width = max(map(len, rows), default=0)
    out = np.zeros((len(rows), width), np.int32)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


class Model:
    """`weights` score label 1 against label 0 for each feature; `edges[a, b]` scores b after a."""

    def __init__(self, weights: np.ndarray, edges: np.ndarray):
        self.weights, self.edges = weights, edges

    def scores(self, features: list[list[int]]) -> np.ndarray:
        return self.weights[padded(features)].sum(axis=1) if features else np.zeros(0)

    def decode(self, features: list[list[int]]) -> list[int]:
        """Viterbi: the best sequence of labels."""
        best0 = best1 = 0.0
        back: list[tuple[int, int]] = []
        (e00, e01), (e10, e11) = self.edges.tolist()
        for i, score in enumerate(self.scores(features).tolist()):
            if i == 0:
                best0, best1 = 0.0, score
                continue
            from0, from1 = int(best1 + e10 > best0 + e00), int(best1 + e11 > best0 + e01)
            best0, best1 = (best1 + e10 if from0 else best0 + e00), (best1 + e11 if from1 else best0 + e01) + score
            back.append((from0, from1))
        if not features:
            return []
        labels = [int(best1 > best0)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def _log_add(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(pages: list[tuple[list[list[int]], list[int]]], rounds: int = 120, rate: float = 0.15, penalty: float = 1e-4) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam on all pages at once; forward-backward for the gradient.

    Longer pages are taken as several chains, so that one of them does not set the width of all.
    """
    pages = [(f[i : i + CHAIN], y[i : i + CHAIN]) for f, y in pages for i in range(0, len(f), CHAIN)]
    size, longest = len(pages), max(len(f) for f, _ in pages)
    flat = padded([row for f, _ in pages for row in f])
    there = np.zeros((size, longest), bool)
    gold = np.zeros((size, longest), np.int64)
    for i, (_, y) in enumerate(pages):
        there[i, : len(y)] = True
        gold[i, : len(y)] = y
    weights, edges = np.zeros(DIMENSIONS), np.zeros((2, 2))
    both = there[:, 1:] & there[:, :-1]
    gold_edges = np.zeros((2, 2))
    np.add.at(gold_edges, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    moments = [np.zeros(DIMENSIONS + 4), np.zeros(DIMENSIONS + 4)]
    total = there.sum()
    for step in range(1, rounds + 1):
        score = np.zeros((size, longest, 2))
        score[..., 1][there] = weights[flat].sum(axis=1)
        ahead = np.zeros((size, longest, 2))
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            moved = _log_add(ahead[:, t - 1, :, None] + edges, 1) + score[:, t]
            ahead[:, t] = np.where(there[:, t, None], moved, ahead[:, t - 1])
        whole = _log_add(ahead[:, -1], 1)
        behind = np.zeros((size, longest, 2))
        expected = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            after = edges + (score[:, t + 1] + behind[:, t + 1])[:, None, :]
            joint = np.exp(ahead[:, t, :, None] + after - whole[:, None, None])
            expected += joint[there[:, t + 1]].sum(axis=0)
            behind[:, t] = np.where(there[:, t + 1, None], _log_add(after, 2), 0)
        p1 = np.exp(ahead[..., 1] + behind[..., 1] - whole[:, None])
        # Padded positions carry the last state on; only real ones count.
        slack = np.where(there, gold - p1, 0)
        gradient = np.bincount(flat.ravel(), np.repeat(slack[there], flat.shape[1]), DIMENSIONS) / total - penalty * weights
        gradient[0] = 0
        full = np.concatenate([gradient, ((gold_edges - expected) / total - penalty * edges).ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * full
        moments[1] = 0.999 * moments[1] + 0.001 * full**2
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        weights += move[:DIMENSIONS]
        edges += move[DIMENSIONS:].reshape(2, 2)
        weights[0] = 0
    return Model(weights, edges)
