"""Boosted regression trees on the logistic loss, as Spark's GBTClassifier grows them, over a table of unlike rows with the weights of either class."""

from __future__ import annotations

import numpy as np


def thresholds(x: np.ndarray, w: np.ndarray, bins: int) -> np.ndarray:
    """Middles between neighbouring values; if there are more than `bins` values, those nearest to equal shares of the weight."""
    values, at = np.unique(x[w > 0], return_inverse=True)
    middles = (values[:-1] + values[1:]) / 2
    if len(values) <= bins:
        return middles
    counts = np.bincount(at, w[w > 0])
    stride, so_far, kept = counts.sum() / bins, np.cumsum(counts), []
    target = stride
    for i, middle in enumerate(middles):
        if abs(so_far[i] - target) < abs(so_far[i + 1] - target):
            kept.append(middle)
            target += stride
    return np.array(kept)


def boosted(x: np.ndarray, ours: np.ndarray, others: np.ndarray, iterations: int, depth: int, bins: int, step: float) -> np.ndarray:
    """P(class) of each row of x (rows x features), trained on all rows; a row counts with weight `ours` as the class and `others` as not. A value's bin ends at its threshold; the first of equally good splits is taken."""
    w = ours + others
    codes = []
    for column in x.T:
        if len(t := thresholds(column, w, bins)):
            codes.append((np.searchsorted(t, column), len(t) + 1))
    least, every = w[w > 0].min() / 2, np.arange(len(x))
    table = np.array([c for c, _ in codes], dtype=np.intp).reshape(len(codes), len(x))
    features = np.repeat(np.arange(len(codes)), [n - 1 for _, n in codes])
    ends = np.concatenate([np.arange(n - 1) for _, n in codes]) if codes else np.zeros(0, np.intp)

    def tree(wr: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.intp)
        for level in range(depth if codes else 0):
            nodes = 2**level
            total_s, total_w = np.bincount(node, wr, nodes)[:, None], np.bincount(node, w, nodes)[:, None]
            gains = []
            for c, (_, n) in zip(table, codes):
                key = node * n + c
                s, v = (np.cumsum(np.bincount(key, z, nodes * n).reshape(nodes, n), axis=1)[:, :-1] for z in (wr, w))
                fine = (v > least) & (total_w - v > least)
                gains.append(np.where(fine, s * s / np.where(fine, v, 1) + (total_s - s) ** 2 / np.where(fine, total_w - v, 1), -1.0))
            gains = np.concatenate(gains, axis=1)
            best = (gains >= gains.max(axis=1, keepdims=True) * (1 - 1e-12)).argmax(axis=1)
            whole = total_s[:, 0] ** 2 / np.maximum(total_w[:, 0], least)
            split = gains[np.arange(nodes), best] > whole * (1 + 1e-12)
            end = np.where(split, ends[best], bins)  # else all go left
            node = 2 * node + (table[features[best][node], every] > end[node])
        s, v = np.bincount(node, wr), np.bincount(node, w)
        return (s / np.maximum(v, least))[node]

    margin = tree(ours - others)
    with np.errstate(over="ignore"):
        for _ in range(iterations - 1):
            margin += step * tree(4 * ours / (1 + np.exp(2 * margin)) - 4 * others / (1 + np.exp(-2 * margin)))
        return 1 / (1 + np.exp(-2 * margin))
