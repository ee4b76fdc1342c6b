"""Quality rules: fixed rules over document statistics, then gradient-boosted trees over them.

The trees are fitted by second-order boosting of the logistic loss over binned features. A feature
may be declared monotone: more of it never raises (-1) or never lowers (+1) the score. The fitted
trees are flat numpy arrays, so a batch of documents walks down all of them level by level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from .common import binary, over_batches
from .text_stats import COUNTS, FEATURES, describe_all
from .training import SAMPLE_ROWS, labelled_features

#: More symbols, marks, repeated lines or words never make a document better.
MONOTONE = {
    "symbols_per_char": -1,
    "symbol_ended_share": -1,
    "marks_per_char": -1,
    "dup_line_share": -1,
    "repeat_word_share": -1,
    "echo_share": -1,
    "top_word_share": -1,
    "upper_per_char": -1,
}


@dataclass(frozen=True)
class Forest:
    """Trees as arrays of shape (trees, nodes); a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for tree in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                below = x[rows, self.feature[tree][node]] <= self.threshold[tree][node]
                node = np.where(below, self.left[tree][node], self.right[tree][node])
            total += self.value[tree][node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_forest(
    x: np.ndarray,
    y: np.ndarray,
    monotone: list[int],
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    ridge: float = 1.0,
    least: float = 5.0,
) -> Forest:
    """Boosted trees for labels 0 and 1. Without rows, or with one label only, no tree splits."""
    n, width = x.shape if len(x) else (0, len(monotone))
    share = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(share / (1 - share)))
    nodes = 2 ** (depth + 1) - 1
    feature = np.zeros((trees, nodes), np.int64)
    threshold = np.full((trees, nodes), np.inf)
    left = np.tile(np.arange(nodes), (trees, 1))
    right = left.copy()
    value = np.zeros((trees, nodes))
    if not n or y.min() == y.max():
        return Forest(feature[:0], threshold[:0], left[:0], right[:0], value[:0], start, depth)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(width)])
    margin = np.full(n, start)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        bound = {0: (-np.inf, np.inf)}
        for level in range(depth + 1):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                if k not in bound:
                    continue
                rows = np.flatnonzero(node == k)
                low, high = bound[k]
                value[tree, k] = rate * _clipped(grad[rows].sum(), hess[rows].sum(), ridge, low, high)
                if level == depth:
                    continue
                best = _best_split(binned[:, rows], grad[rows], hess[rows], cuts, monotone, ridge, least, low, high)
                if best is None:
                    continue
                j, cut, left_value, right_value = best
                feature[tree, k], threshold[tree, k] = j, cuts[j][cut]
                left[tree, k], right[tree, k] = 2 * k + 1, 2 * k + 2
                node[rows] = np.where(binned[j, rows] <= cut, 2 * k + 1, 2 * k + 2)
                middle = (left_value + right_value) / 2
                sign = monotone[j]
                bound[2 * k + 1] = (max(low, middle), high) if sign < 0 else (low, min(high, middle)) if sign > 0 else (low, high)
                bound[2 * k + 2] = (low, min(high, middle)) if sign < 0 else (max(low, middle), high) if sign > 0 else (low, high)
        margin += value[tree][node]
    return Forest(feature, threshold, left, right, value, start, depth)


def _clipped(grad, hess, ridge, low, high):
    return np.clip(grad / (hess + ridge), low, high)


def _best_split(binned, grad, hess, cuts, monotone, ridge, least, low, high):
    """(feature, cut, left value, right value) of the largest gain that respects the constraints."""
    total_g, total_h = grad.sum(), hess.sum()
    whole = total_g**2 / (total_h + ridge)
    best, most = None, whole + 1e-6
    for j, edges in enumerate(cuts):
        if not len(edges):
            continue
        size = len(edges) + 1
        g = np.bincount(binned[j], grad, size).cumsum()[:-1]
        h = np.bincount(binned[j], hess, size).cumsum()[:-1]
        c = np.bincount(binned[j], minlength=size).cumsum()[:-1]
        a, b = _clipped(g, h, ridge, low, high), _clipped(total_g - g, total_h - h, ridge, low, high)
        gain = 2 * (a * g + b * (total_g - g)) - a**2 * (h + ridge) - b**2 * (total_h - h + ridge)
        wrong = (b - a) * monotone[j] < 0 if monotone[j] else False
        gain = np.where(wrong | (c < least) | (len(grad) - c < least), -np.inf, gain)
        at = int(gain.argmax())
        if gain[at] > most:
            best, most = (j, at, float(a[at]), float(b[at])), gain[at]
    return best


def fit_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", where: Column | None = None,
              id_col: str = "doc_id", text_col: str = "text", max_rows: int = SAMPLE_ROWS) -> Forest:
    """Trees learned from at most ``max_rows`` labelled documents."""
    x, y = labelled_features(docs, labels, label, where, id_col, text_col, max_rows)
    return fit_forest(x, y, [MONOTONE.get(name, 0) for name in FEATURES])


def apply_rules(
    docs: DataFrame,
    forest: Forest,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = 50,
    most_repeated_percent: int = 50,
    least_score: float = 0.5,
) -> DataFrame:
    """(id, counts, base_failed, score, kept) per row of ``docs``.

    Null, empty and white-space texts have no words: all counts 0, base_failed, not kept. A row
    with a null id gets its result like any other; repeated rows get one result each.
    """

    def judge(batches):
        for batch in batches:
            counts, x = describe_all(binary(batch, text_col))
            score = forest.probability(x)
            failed = (counts[:, 0] < least_words) | (100 * counts[:, 4] > most_repeated_percent * counts[:, 0])
            yield pa.record_batch(
                [batch.column(0), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(failed), pa.array(score),
                 pa.array(~failed & (score >= least_score))],
                names=[id_col, *COUNTS, "base_failed", "score", "kept"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return over_batches(docs, [id_col, text_col], judge, f"{id_col} {kind}, {counts}, base_failed boolean, score double, kept boolean")
