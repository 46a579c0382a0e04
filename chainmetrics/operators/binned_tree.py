"""Entropy decision tree over packed blocks of binned rows, grown as MLlib grows it.

The tree is that of MLlib's ``DecisionTreeClassifier``: bins as in ``binary_boosting``, a split maximises the
fall of entropy, ties go to the smaller feature, then threshold; a node is a leaf if it is pure, at the
greatest depth, or nothing falls. Its prediction is its most frequent class (ties to the smaller). Null and NaN
features count as larger than any other value.

Rows are binned once and kept in blocks, a byte a feature. Large nodes are split level by level, a pass
each that adds up class counts by (node, feature, bin). Nodes of at most ``LOCAL_ROWS`` rows are finished
by one task each; tasks get nodes of about equal numbers of rows in all. The tree never reaches the driver: it
is a table as in ``exact_tree``. In the driver are only the sample for the bins, counts and the large nodes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainmetrics.operators import binary_boosting as BB
from chainmetrics.operators import exact_tree as T
from chainmetrics.session import checkpoint_root, materialize, ship_package

LOCAL_ROWS = 500_000
#: Counts (node x bin x class) of a feature that a task holds at once while it finishes a node.
CHUNK_CELLS = 1 << 21
#: Class labels are kept in a signed byte.
MOST_CLASSES = 100


@dataclass
class Model:
    """A tree table over named features."""

    features: tuple[str, ...]
    tree: DataFrame
    prediction: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        """Append the class to every row."""
        return T.predict(df, self.tree, self.features, self.prediction, BB.numbers)

    def save(self, spark, path: str) -> None:
        """Two tables below ``path`` (A13), overwritten: ``nodes``, and ``features`` by number."""
        self.tree.write.mode("overwrite").parquet(f"{path}/nodes")
        (spark.createDataFrame([(i, f, self.prediction) for i, f in enumerate(self.features)], "i int, feature string, prediction string")
         .coalesce(1).write.mode("overwrite").parquet(f"{path}/features"))


def load(spark, path: str) -> Model:
    """A model stored by ``Model.save``."""
    names = sorted(spark.read.parquet(f"{path}/features").collect(), key=lambda r: r.i)
    return Model(tuple(r.feature for r in names), spark.read.parquet(f"{path}/nodes"), names[0].prediction)


def _entropy(counts: np.ndarray) -> np.ndarray:
    """Of rows of class counts, class by class as MLlib adds it up: gains that are equal stay equal."""
    total, out = counts.sum(-1), np.zeros(len(counts))
    for k in range(counts.shape[-1]):
        share = counts[:, k] / total
        out -= np.where(share > 0, share * (np.log(np.where(share > 0, share, 1.0)) / np.log(2.0)), 0.0)
    return out


def best_bins(cells: np.ndarray, whole: np.ndarray, impurity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gain, last bin to the left) of every node's best split by one feature; -inf where all its rows are in
    one bin. ``cells``: nodes x bins x classes, ``whole``: nodes x classes."""
    left, sizes = cells.cumsum(1), whole.sum(1)
    # An empty bin only repeats the split before it.
    node, at = np.nonzero(cells.any(2) & (left.sum(2) < sizes[:, None]))
    a, n = left[node, at], sizes[node]
    b = whole[node] - a
    gains = np.full(cells.shape[:2], -np.inf)
    gains[node, at] = impurity[node] - a.sum(1) / n * _entropy(a) - b.sum(1) / n * _entropy(b)
    best = gains.argmax(1)
    return gains[np.arange(len(gains)), best], best


# -- local part ------------------------------------------------------------------

def grow(bins: np.ndarray, y: np.ndarray, classes: int, depth: int) -> list[np.ndarray]:
    """Columns node, feature (-1: leaf), bin, gain, left, right, n, prediction of a whole subtree of at most
    ``depth`` levels over ``bins`` (features x rows), all nodes of a level at once."""
    slot, whole, numbers = np.zeros(len(y), np.int64), np.bincount(y, minlength=classes)[None], np.zeros(1, np.int64)
    out, made, most = [], 1, int(bins.max(initial=0)) + 1
    each = most * classes
    step = max(1, CHUNK_CELLS // each)
    for level in range(depth + 1):
        gain, feature, bin_ = np.full(len(whole), -np.inf), np.full(len(whole), -1), np.zeros(len(whole), np.int64)
        impurity = _entropy(whole)
        for s in range(0, len(whole) if level < depth else 0, step):  # rows are in the order of their nodes
            part = slice(*np.searchsorted(slot, (s, s + step)))
            nodes = slice(s, s + step)
            size = len(whole[nodes])
            base = (slot[part] - s) * each + y[part]
            for f in range(len(bins)):
                cells = np.bincount(base + bins[f, part].astype(np.int64) * classes, minlength=size * each).reshape(size, most, classes)
                g, b = best_bins(cells, whole[nodes], impurity[nodes])
                better = s + np.flatnonzero(g > gain[nodes])
                gain[better], feature[better], bin_[better] = g[better - s], f, b[better - s]
        split = gain > 0
        feature = np.where(split, feature, -1)
        left = np.where(split, made + 2 * (np.cumsum(split) - 1), -1)
        out.append((numbers, feature, bin_, np.where(split, gain, 0.0), left, np.where(split, left + 1, -1), whole.sum(1), whole.argmax(1)))
        rows = np.flatnonzero(split[slot])
        if not len(rows):
            break
        at = slot[rows]
        child = 2 * (np.cumsum(split) - 1)[at] + (bins[feature[at], rows] > bin_[at])
        below = np.bincount(child * classes + y[rows], minlength=2 * int(split.sum()) * classes).reshape(-1, classes)
        open_ = np.count_nonzero(below, axis=1) > 1
        children = made + np.arange(len(below))
        made += len(below)
        pure, none = below[~open_], np.full(int((~open_).sum()), -1)
        out.append((children[~open_], none, none, none * 0.0, none, none, pure.sum(1), pure.argmax(1)))
        if not open_.any():
            break
        kept = np.flatnonzero(open_[child])
        kept = kept[np.argsort(child[kept], kind="stable")]
        slot, rows = (np.cumsum(open_) - 1)[child[kept]], rows[kept]
        bins, y, whole, numbers = bins[:, rows], y[rows], below[open_], children[open_]
    return [np.concatenate(c) for c in zip(*out)]


# -- distributed part ------------------------------------------------------------

def _router(top: T._Top):
    """The large node of every row (features x rows), or the child of one that it ends in."""
    feature, left, right = (np.array(v, np.int64) for v in (top.feature, top.left, top.right))
    last = np.array(top.threshold)

    def route(bins: np.ndarray) -> np.ndarray:
        at, todo = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        while len(todo := todo[feature[at[todo]] >= 0]):
            here = at[todo]
            at[todo] = np.where(bins[feature[here], todo] <= last[here], left[here], right[here])
        return at

    return route


def _cells(blocks: RDD, top: T._Top, nodes: list[int], width: int, most: int, classes: int) -> np.ndarray:
    """Class counts (features x nodes x bins x classes) of some nodes."""
    route, place, each = _router(top), np.full(len(top.root), -1), most * classes
    place[nodes] = np.arange(len(nodes))
    size = len(nodes) * each

    def run(part):
        total = np.zeros((width, size), np.int64)
        for bins, y in part:
            slot = place[route(bins)]
            rows = np.flatnonzero(slot >= 0)
            if len(rows) < len(slot):
                bins, y, slot = bins.take(rows, axis=1), y[rows], slot[rows]
            base = slot * each + y
            for f in range(width):
                total[f] += np.bincount(base + bins[f].astype(np.int64) * classes, minlength=size)
        yield total

    return blocks.mapPartitions(run).reduce(np.add).reshape(width, len(nodes), most, classes)


def _grown(roots: list[str], classes: int, depth: int, cuts: list[np.ndarray]):
    """Finishes a node with thresholds instead of bins."""

    def run(node, arrays):
        bins, y = arrays
        grown = grow(bins, y.astype(np.int64), classes, depth - len(roots[node]))
        threshold = np.zeros(len(grown[0]))
        for f, c in enumerate(cuts):
            mine = grown[1] == f
            threshold[mine] = c[grown[2][mine]]
        return [*grown[:2], threshold, *grown[3:]]

    return run


def fit(train: DataFrame, features: Sequence[str], label: str, depth: int, prediction: str, seed: int = 0, local_rows: int = LOCAL_ROWS) -> Model:
    """The tree of ``train``. Rows are read three times: they should be stored."""
    spark, width = train.sparkSession, len(features)
    ship_package(spark)
    checkpoint_root(spark)
    y = F.col(label)
    n, fit_for, most = train.agg(F.count(F.lit(1)), F.count_if(y.between(0, MOST_CLASSES - 1) & (y == y.cast("int"))), F.max(y)).first()
    if not n or n != fit_for:
        raise ValueError(f"{n} training rows, {fit_for} of them labelled by a class")
    classes = int(most) + 1
    binned = BB.binned(train, features, n, prediction, seed)
    most_bins = max(len(c) for c in binned.cuts) + 1
    parts = max(1, min(spark.sparkContext.defaultParallelism, n // BB.BLOCK_ROWS))
    blocks = BB.packed(train, label, binned, parts).persist(StorageLevel.MEMORY_AND_DISK)
    top, made, small, level = T._Top(), [], {}, 0
    sums = np.array(blocks.map(lambda b: np.bincount(b[1], minlength=classes)).reduce(np.add))
    open_ = {0: sums}

    def leaf(node, counts):
        made.append((top.root[node], 0, None, None, None, None, None, int(counts.sum()), int(counts.argmax())))

    while open_:
        large = {}
        for node, counts in open_.items():
            if level == depth or counts.max() == counts.sum():
                leaf(node, counts)
            elif counts.sum() <= local_rows:
                small[node] = int(counts.sum())
            else:
                large[node] = counts
        open_ = {}
        if large:
            nodes, whole = list(large), np.stack(list(large.values()))
            cells, impurity = _cells(blocks, top, nodes, width, most_bins, classes), _entropy(whole)
            found = [best_bins(c, whole, impurity) for c in cells]
            for i, node in enumerate(nodes):
                gains = [g[i] for g, _ in found]
                f = int(np.argmax(gains))
                if gains[f] <= 0:
                    leaf(node, whole[i])
                    continue
                b = int(found[f][1][i])
                made.append((top.root[node], 0, f, float(binned.cuts[f][b]), float(gains[f]), -1, -1, int(whole[i].sum()), int(whole[i].argmax())))
                a = cells[f, i, :b + 1].sum(0)
                left, right = top.split(node, f, b)
                open_ |= {left: a, right: whole[i] - a}
        level += 1
    tree = spark.createDataFrame(made, T.TREE)
    if small:
        tasks = max(4 * parts, sum(small.values()) // local_rows)
        route = _router(top)
        tree = tree.unionByName(T.finished(spark, blocks, lambda b: (route(b[0]), b), small, top.root, tasks,
                                           _grown(top.root, classes, depth, binned.cuts)))
    tree = materialize(tree)
    blocks.unpersist()
    return Model(tuple(features), tree, prediction)
