"""Histogram gradient-boosted trees for a 0/1 label, in numpy, and their flat form for scoring."""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import ship

TREES, DEPTH, RATE, BINS = 80, 4, 0.1, 64
LEAF_HESSIAN, RIDGE = 3.0, 1.0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> dict:
    """A model as flat arrays: split features and thresholds of full trees, and leaf values.

    Without rows, or with one label only, it is the smoothed share of label 1.
    """
    n, width = x.shape
    start = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feature = np.zeros((trees, inner), np.int32)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    model = {"start": start, "depth": depth, "feature": feature, "threshold": threshold, "value": value}
    if n == 0 or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(width)]
    bins = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    score = np.full(n, start)
    for t in range(trees):
        p = sigmoid(score)
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)  # place in the level
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            best = np.full(count, 1e-6)
            all_g, all_h = (np.bincount(node, w, minlength=count) for w in (g, h))
            for f in range(width):
                if not len(edges[f]):
                    continue
                at = node * BINS + bins[:, f]
                left_g, left_h = (np.bincount(at, w, minlength=count * BINS).reshape(count, BINS).cumsum(axis=1)
                                  [:, :len(edges[f])] for w in (g, h))
                right_g, right_h = all_g[:, None] - left_g, all_h[:, None] - left_h
                gain = (left_g ** 2 / (left_h + RIDGE) + right_g ** 2 / (right_h + RIDGE)
                        - (all_g ** 2 / (all_h + RIDGE))[:, None])
                gain[(left_h < LEAF_HESSIAN) | (right_h < LEAF_HESSIAN)] = 0
                top = gain.argmax(axis=1)
                value_of = gain[np.arange(count), top]
                better = value_of > best
                best[better] = value_of[better]
                feature[t, first:first + count][better] = f
                threshold[t, first:first + count][better] = edges[f][top[better]]
            mine = first + node
            node = 2 * node + (x[np.arange(n), feature[t, mine]] > threshold[t, mine])
        sum_g, sum_h = (np.bincount(node, w, minlength=leaves) for w in (g, h))
        value[t] = rate * sum_g / (sum_h + RIDGE)
        score += value[t, node]
    return model


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1; all rows walk down each tree together."""
    out = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for feature, threshold, value in zip(model["feature"], model["threshold"], model["value"], strict=True):
        at = np.zeros(len(x), np.int64)
        for _ in range(model["depth"]):
            at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
        out += value[at - len(feature)]
    return sigmoid(out)


ship(__name__)
