"""Linear-chain conditional random field with two labels over sets of binary features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

Page = Sequence[Sequence[str]]


@dataclass(frozen=True)
class Model:
    """Weight of each feature for label 1 against label 0, of each pair of neighbouring labels, and of the first."""

    weights: dict[str, float]
    steps: tuple[tuple[float, float], tuple[float, float]]
    first: tuple[float, float]

    def scores(self, page: Page) -> list[float]:
        get = self.weights.get
        return [sum([get(f, 0.0) for f in block]) for block in page]

    def decode(self, scores: Sequence[float]) -> list[int]:
        """The best label sequence (Viterbi); ties go to label 0."""
        if not scores:
            return []
        (s00, s01), (s10, s11) = self.steps
        zero, one = self.first[0], self.first[1] + scores[0]
        back: list[tuple[int, int]] = []
        for x in scores[1:]:
            from0 = 0 if zero + s00 >= one + s10 else 1
            from1 = 0 if zero + s01 >= one + s11 else 1
            back.append((from0, from1))
            zero, one = (
                (zero + s00 if from0 == 0 else one + s10),
                (zero + s01 if from1 == 0 else one + s11) + x,
            )
        label = int(one > zero)
        labels = [label]
        for pair in reversed(back):
            label = pair[label]
            labels.append(label)
        return labels[::-1]


def train(pages: Sequence[Page], labels: Sequence[Sequence[int]], rounds: int = 250, l2: float = 5e-5, rate: float = 0.1) -> Model:
    """Maximum conditional likelihood with an L2 penalty, by Adam over all pages at once."""
    kept = [i for i, p in enumerate(pages) if len(p)]
    if not kept:
        raise ValueError("no labelled page has a block")
    pages, labels = [pages[i] for i in kept], [labels[i] for i in kept]
    names = {f: i for i, f in enumerate(sorted({f for p in pages for b in p for f in b}))}
    count, longest = len(pages), max(len(p) for p in pages)
    cell = np.array([i * longest + t for i, p in enumerate(pages) for t, b in enumerate(p) for _ in b])
    feature = np.array([names[f] for p in pages for b in p for f in b])
    real = np.zeros((count, longest), bool)
    truth = np.zeros((count, longest))
    for i, (p, y) in enumerate(zip(pages, labels)):
        real[i, : len(p)] = True
        truth[i, : len(p)] = y
    blocks = real.sum()
    pair = np.zeros((2, 2))
    inner = real[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            pair[a, b] = np.sum(inner & (truth[:, :-1] == a) & (truth[:, 1:] == b))
    start = np.array([np.sum(truth[:, 0] == 0), np.sum(truth[:, 0] == 1)], float)
    theta = np.zeros(len(names) + 6)
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    for n in range(1, rounds + 1):
        step, first = theta[-6:-2].reshape(2, 2), theta[-2:]
        emit = np.bincount(cell, theta[feature], count * longest).reshape(count, longest)
        alpha = np.zeros((count, longest, 2))
        beta = np.zeros((count, longest, 2))
        score = np.stack([np.zeros_like(emit), emit], axis=2)
        alpha[:, 0] = first + score[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(alpha[:, t - 1, :1] + step[0], alpha[:, t - 1, 1:] + step[1]) + score[:, t]
            alpha[:, t] = np.where(real[:, t, None], new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = score[:, t + 1] + beta[:, t + 1]
            new = np.stack([np.logaddexp(step[a, 0] + ahead[:, 0], step[a, 1] + ahead[:, 1]) for a in (0, 1)], axis=1)
            beta[:, t] = np.where(real[:, t + 1, None], new, 0.0)
        whole = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        node = np.exp(alpha + beta - whole[:, None, None])
        expected = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                edge = alpha[:, :-1, a] + step[a, b] + score[:, 1:, b] + beta[:, 1:, b] - whole[:, None]
                expected[a, b] = np.exp(edge[inner]).sum()
        slope = np.empty_like(theta)
        slope[:-6] = np.bincount(feature, ((truth - node[:, :, 1]) * real).reshape(-1)[cell], len(names))
        slope[-6:-2] = (pair - expected).reshape(-1)
        slope[-2:] = start - node[:, 0].sum(axis=0)
        slope = slope / blocks - l2 * theta
        moment = 0.9 * moment + 0.1 * slope
        square = 0.999 * square + 0.001 * slope * slope
        theta = theta + rate * (moment / (1 - 0.9**n)) / (np.sqrt(square / (1 - 0.999**n)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in names.items()}
    s = theta[-6:-2]
    return Model(weights, ((float(s[0]), float(s[1])), (float(s[2]), float(s[3]))), (float(theta[-2]), float(theta[-1])))
