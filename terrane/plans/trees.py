"""The trees of a fitted Spark ML ensemble as arrays, to score variants of a row without making rows of them.

Importance, dependence and attribution ask for a row's prediction with some features replaced, tens of times a row. Rows
made for them cost far more than the trees: here a task walks the trees for a batch of feature vectors at once, and a
variant is walked only from the split where it leaves the row's own path.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows walked at once: with 50 trees, arrays of 25,000 places, which a core's cache holds.
WALKED_ROWS = 500

_TREE = re.compile(r"\s*Tree \d+ \(weight (\S+)\):")
_SPLIT = re.compile(r"\s*If \(feature (\d+) (?:<= (\S+)|in \{(.*)\})\)")
_LEAF = re.compile(r"\s*Predict: (\S+)")


@dataclass
class Trees:
    """Nodes of all trees: a leaf has no feature (-1) and its tree's weight times its prediction as value. A split sends
    a row left by its threshold or, where ``categories`` is not 0, if the bit of the row's category is set there."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    categories: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def goes_left(self, node: np.ndarray, x: np.ndarray) -> np.ndarray:
        left = x <= self.threshold.take(node)  # NaN: right, as in Spark
        if self.categories.any():
            bits = self.categories.take(node)
            at = np.flatnonzero(bits)
            left[at] = (bits[at] >> x[at].astype(np.uint64)) & np.uint64(1) == 1
        return left

    def leaves(self, node: np.ndarray, take) -> np.ndarray:
        """The leaves reached from ``node``; ``take(places, features)`` gives the places' values of these features."""
        node = node.copy()
        going = np.flatnonzero(self.feature.take(node) >= 0)
        while len(going):
            here = node.take(going)
            left = self.goes_left(here, take(going, self.feature.take(here)))
            node[going] = here = np.where(left, self.left.take(here), self.right.take(here))
            going = going.compress(self.feature.take(here) >= 0)
        return node

    def trees_with(self, feature: int) -> np.ndarray:
        """The trees that split on ``feature``."""
        return np.unique(np.searchsorted(self.roots, np.flatnonzero(self.feature == feature), side="right") - 1)


def of_model(model) -> Trees:
    """The trees of a fitted ensemble, read from its description (which prints numbers in full)."""
    roots, weights, feature, threshold, categories, left, right, value = ([] for _ in range(8))
    open_splits: list[int] = []
    for line in model.toDebugString.splitlines():
        tree, split, leaf = _TREE.match(line), _SPLIT.match(line), _LEAF.match(line)
        if tree:
            roots.append(len(feature))
            weights.append(float(tree[1]))
        if not (split or leaf):
            continue
        node = len(feature)
        if open_splits:  # nodes come in depth-first order, the left side first
            above = open_splits[-1]
            if left[above] < 0:
                left[above] = node
            else:
                right[open_splits.pop()] = node
        if split:
            open_splits.append(node)
        feature.append(int(split[1]) if split else -1)
        threshold.append(float(split[2]) if split and split[2] else np.nan)
        categories.append(sum(1 << int(float(c)) for c in split[3].split(",")) if split and split[3] else 0)
        left.append(-1)
        right.append(-1)
        value.append(0.0 if split else weights[-1] * float(leaf[1]))
    share = len(roots) if isinstance(model, RandomForestRegressionModel) else 1
    return Trees(np.array(roots, np.int32), np.array(feature, np.int32), np.array(threshold), np.array(categories, np.uint64),
                 np.array(left, np.int32), np.array(right, np.int32), np.array(value) / share)


def shared_trees(model: PipelineModel, spark: SparkSession) -> Broadcast:
    """The trees' arrays for tasks, which make ``Trees(**value)`` of them (they may not have this module to import)."""
    return spark.sparkContext.broadcast(vars(of_model(model.stages[-1])))


def vectors(model: PipelineModel, rows: DataFrame, *keep: str | Column) -> DataFrame:
    """``keep`` and the rows' feature vectors (``features``), by all stages but the ensemble."""
    return PipelineModel(model.stages[:-1]).transform(rows).select(*keep, vector_to_array("features").alias("features"))


def position(model: PipelineModel, column: str) -> int:
    """The place of a numeric column in the feature vectors (they come before the categories' vectors)."""
    return model.stages[-2].getInputCols().index(column)


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1 if len(column) else 0)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``WALKED_ROWS``."""
    for batch in batches:
        for start in range(0, len(batch), WALKED_ROWS):
            yield batch.slice(start, WALKED_ROWS)


def own_leaves(trees: Trees, x: np.ndarray, some: np.ndarray | None = None) -> np.ndarray:
    """Rows x trees (or ``some`` of them): the rows' leaves."""
    roots = trees.roots if some is None else trees.roots[some]
    flat, first = x.ravel(), np.repeat(np.arange(len(x)) * x.shape[1], len(roots))
    return trees.leaves(np.tile(roots, len(x)), lambda at, f: flat.take(first.take(at) + f)).reshape(len(x), len(roots))


def over_grid(trees: Trees, x: np.ndarray, feature: int, grid: np.ndarray) -> np.ndarray:
    """Rows x grid: the predictions with ``feature`` at each value of the ascending ``grid``. At a split on it the part
    of the grid that goes right leaves the one that goes left."""
    n, size = len(x), len(grid)
    flat, width = x.ravel(), x.shape[1]
    cut = np.searchsorted(grid, trees.threshold, side="right")
    row, node = np.repeat(np.arange(n), len(trees.roots)), np.tile(trees.roots, n)
    lo, hi = np.zeros(len(row), np.int64), np.full(len(row), size)
    change = np.zeros(n * (size + 1))
    while len(row):
        f = trees.feature.take(node)
        leaf = f < 0
        if leaf.any():
            first, worth = row.compress(leaf) * (size + 1), trees.value.take(node.compress(leaf))
            change += np.bincount(first + lo.compress(leaf), worth, len(change)) - np.bincount(first + hi.compress(leaf), worth, len(change))
            row, node, lo, hi, f = (a.compress(~leaf) for a in (row, node, lo, hi, f))
        free, at = f == feature, cut.take(node)
        goes = trees.goes_left(node, flat.take(row * width + f))
        left_hi = np.where(free, np.minimum(hi, at), np.where(goes, hi, lo))
        right_lo = np.where(free, np.maximum(lo, at), np.where(goes, hi, lo))
        left, right = np.flatnonzero(lo < left_hi), np.flatnonzero(right_lo < hi)
        row, node = (np.concatenate([row.take(left), row.take(right)]),
                     np.concatenate([trees.left.take(node.take(left)), trees.right.take(node.take(right))]))
        lo, hi = np.concatenate([lo.take(left), right_lo.take(right)]), np.concatenate([left_hi.take(left), hi.take(right)])
    return change.reshape(n, size + 1).cumsum(axis=1)[:, :size]


def with_donors(trees: Trees, x: np.ndarray, donors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' own predictions, and rows x features: those with one feature at the donor's value."""
    n, k = x.shape
    own_x, other_x = x.ravel(), donors.ravel()
    row, node = np.repeat(np.arange(n), len(trees.roots)), np.tile(trees.roots, n)
    going = np.arange(len(row))
    left_at, left_to, left_by = [], [], []  # where a variant leaves the row's path, to which node, by which feature
    gone = np.zeros(len(row) * k, bool)  # it leaves a tree's path once
    while len(going := going.compress(trees.feature.take(node.take(going)) >= 0)):
        here = node.take(going)
        f = trees.feature.take(here)
        value = row.take(going) * k + f
        goes, other = trees.goes_left(here, own_x.take(value)), trees.goes_left(here, other_x.take(value))
        left, right = trees.left.take(here), trees.right.take(here)
        node[going] = np.where(goes, left, right)
        parts = np.flatnonzero(goes != other)
        once = going.take(parts) * k + f.take(parts)
        parts, once = parts.compress(~gone.take(once)), once.compress(~gone.take(once))
        gone[once] = True
        left_at.append(going.take(parts))
        left_to.append(np.where(other.take(parts), left.take(parts), right.take(parts)))
        left_by.append(f.take(parts))
    own = trees.value.take(node)
    total = np.bincount(row, own, n)
    if not left_at:
        return total, np.repeat(total[:, None], k, axis=1)
    at, to, by = map(np.concatenate, (left_at, left_to, left_by))
    both, whose = np.concatenate([own_x, other_x]), row.take(at) * k
    end = trees.leaves(to, lambda p, f: both.take(whose.take(p) + f + len(own_x) * (f == by.take(p))))
    return total, total[:, None] + np.bincount(whose + by, trees.value.take(end) - own.take(at), n * k).reshape(n, k)
