"""Multi-class gradient boosting: softmax objective, second-order histogram trees.

Every round fits one tree per class to the gradients g = p - [y = class] and curvatures
h = 2 p (1 - p) of the softmax loss at the margins so far. Trees grow level by level: each task
adds up g and h of its rows by (class, node, feature, bin) and sends these cells only,
partial sums meet in one aggregation, and running sums over the bins give the gain

    GL^2 / (HL + reg) + GR^2 / (HR + reg) - G^2 / (H + reg)

of every split, once with missing values going left, once right (and of missing values against
all others); the better way becomes the node's default direction. A leaf weighs -G / (H + reg), times the learning rate. Gains are
compared in millionths; ties go to the smaller feature, threshold, then to missing
values going left. A node without a positive gain, or whose sides would have less than
``least`` curvature, is a leaf.

Bins: quantiles of a bounded sample of rows (``CUT_ROWS``), found once. What reaches the driver
is bounded by the parameters alone: cuts (features x bins) and trees (rounds x classes x
2^depth nodes). Rows keep their bins and margins in a table that is rewritten every round (lineage
is cut there). Null and NaN features are missing; rows without a label don't learn.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainmetrics.operators.classify import BOOST_RATE, BOOST_ROUNDS, hash_share
from chainmetrics.session import materialize, ship_package

# Classes and depth of the reference's booster.
CLASSES = 13
DEPTH = 6
BINS = 64
#: Rows from which the bins' edges are taken at most.
CUT_ROWS = 200_000
UNITS = 1e6
SPLIT = ("feature", "bin", "missing_left", "gain", "gl", "hl", "gr", "hr")


@dataclass
class Tree:
    """Nodes by heap position (children of i: 2i + 1, 2i + 2); feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    weight: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n))

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        """Deepest node of each row of bin numbers (-1: missing)."""
        node = np.zeros(len(bins), np.int64)
        while True:
            f = self.feature[node]
            go = np.flatnonzero(f >= 0)
            if not len(go):
                return node
            b = bins[go, f[go]]
            left = np.where(b < 0, self.missing_left[node[go]], b <= self.bin[node[go]])
            node[go] = 2 * node[go] + np.where(left, 1, 2)


@dataclass
class Model:
    """``rounds`` of one tree per class, and the upper edges of every feature's bins."""

    features: tuple[str, ...]
    cuts: list[np.ndarray]
    rate: float
    rounds: list[list[Tree]]

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin numbers: how many edges lie below the value; -1 for missing values."""
        out = np.empty(x.shape, np.int16)
        for f, edges in enumerate(self.cuts):
            out[:, f] = np.where(np.isnan(x[:, f]), -1, np.searchsorted(edges, x[:, f], "left"))
        return out

    def margins(self, bins: np.ndarray, classes: int) -> np.ndarray:
        out = np.zeros((len(bins), classes))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += self.rate * tree.weight[tree.node_of(bins)]
        return out


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1), kind)


def _values(features: Sequence[str]):
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features])


def cut_points(train: DataFrame, features: Sequence[str], bins: int = BINS, rows: int = CUT_ROWS) -> list[np.ndarray]:
    """Distinct quantiles of each feature's values, from at most about ``rows`` rows."""
    n = train.count()
    some = train if n <= rows else train.where(hash_share(F.xxhash64(*features), rows / n))
    share = [j / bins for j in range(1, bins)]
    got = some.agg(*[F.percentile(F.nullif(F.col(c).cast("double"), F.lit(float("nan"))), F.array(*map(F.lit, share))).alias(f"q{i}")
                     for i, c in enumerate(features)]).first()
    return [np.unique(np.array(q if q is not None else [], float)) for q in got]


def gradients(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = np.exp(margins - margins.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    g = p.copy()
    g[np.arange(len(y)), y] -= 1
    return g, np.maximum(2 * p * (1 - p), 1e-16)


def _cells(rows: DataFrame, trees: list[Tree], level: int, width: int, bins: int) -> DataFrame:
    """Sums of g and h by (class, node, feature, bin) of all rows in nodes of this level."""
    first, nodes = 2**level - 1, 2**level
    shared = rows.sparkSession.sparkContext.broadcast(trees)
    classes = len(trees)

    def run(batches):
        total = np.zeros((2, classes * nodes * width * (bins + 1)))
        for batch in batches:
            b, m = _matrix(batch.column(1), np.int16), _matrix(batch.column(2), np.float64)
            gh = gradients(m, batch.column(0).to_numpy())
            for k, tree in enumerate(shared.value):
                node = tree.node_of(b) - first
                at = np.flatnonzero(node >= 0)
                cell = ((k * nodes + node[at, None]) * width + np.arange(width)) * (bins + 1) + b[at] + 1
                for s in (0, 1):
                    total[s] += np.bincount(cell.ravel(), np.repeat(gh[s][at, k], width), total.shape[1])
        some = np.flatnonzero(total[1] > 0)
        if len(some):
            cell, b = some // (bins + 1), some % (bins + 1) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in ((cell // width // nodes, pa.int32()), (cell // width % nodes + first, pa.int32()), (cell % width, pa.int32()),
                                             (b, pa.int32()), (total[0, some], pa.float64()), (total[1, some], pa.float64()))],
                ["class", "node", "feature", "bin", "g", "h"])

    made = rows.select("y", "bins", "margins").mapInArrow(run, "class int, node int, feature int, bin int, g double, h double")
    return made.groupBy("class", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(cells: DataFrame, cuts: list[np.ndarray], reg: float, least: float) -> DataFrame:
    """(class, node, feature, bin, missing_left, gain, gl, hl, gr, hr, g, h) of the best split of each node;
    the split's columns are null where none has a positive gain."""
    of = Window.partitionBy("class", "node", "feature")
    upto = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    missing = F.col("bin") < 0
    def zero(c):
        return F.coalesce(c, F.lit(0.0))

    sums = cells.select("class", "node", "feature", "bin", *[x for c in ("g", "h") for x in (
        F.sum(c).over(of).alias(c), zero(F.sum(F.when(missing, F.col(c))).over(of)).alias(f"m{c}"),
        zero(F.sum(F.when(~missing, F.col(c))).over(upto)).alias(f"l{c}"))])
    edges = F.array(*[F.lit(len(c)) for c in cuts])

    def score(g, h):
        return g * g / (h + reg)

    def way(left: bool):
        gl, hl = (F.col(f"l{c}") + (F.col(f"m{c}") if left else 0.0) for c in ("g", "h"))
        gr, hr = F.col("g") - gl, F.col("h") - hl
        gain = score(gl, hl) + score(gr, hr) - score(F.col("g"), F.col("h"))
        units = F.floor(gain * UNITS + 0.5).cast("long")
        # Bin -1 with missing values left: they alone go left.
        ok = (F.col("bin") >= (-1 if left else 0)) & (F.col("bin") < F.get(edges, F.col("feature"))) & (hl >= least) & (hr >= least) & (units > 0)
        return F.when(ok, F.struct(units.alias("units"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), F.lit(int(left)).alias("left"),
                                   gl.alias("gl"), hl.alias("hl"), gr.alias("gr"), hr.alias("hr")))

    best = sums.withColumn("s", F.greatest(way(True), way(False))).groupBy("class", "node").agg(
        F.max("s").alias("s"), F.min_by("g", "feature").alias("g"), F.min_by("h", "feature").alias("h"))
    return best.select("class", "node", (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"), (F.col("s.left") == 1).alias("missing_left"),
                       (F.col("s.units") / UNITS).alias("gain"), "s.gl", "s.hl", "s.gr", "s.hr", "g", "h")


def fit(train: DataFrame, features: Sequence[str], label: str = "label", classes: int = CLASSES, rounds: int = BOOST_ROUNDS, rate: float = BOOST_RATE,
        depth: int = DEPTH, bins: int = BINS, reg: float = 1.0, least: float = 1.0) -> Model:
    """Boosted trees for labels 0 .. classes - 1."""
    ship_package(train.sparkSession)
    y = F.col(label).cast("int")
    labelled = materialize(train.where(y.between(0, classes - 1)).select(y.alias("y"), *[F.col(c).cast("double").alias(c) for c in features]))
    model = Model(tuple(features), cut_points(labelled, features, bins), rate, [])
    width = len(features)

    def prepared(batches):
        for batch in batches:
            if batch.num_rows:
                b = model.bins(_matrix(batch.column(1), np.float64))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(b), pa.list_(pa.int16())),
                                                  pa.array([[0.0] * classes] * len(b), pa.list_(pa.float64()))], ["y", "bins", "margins"])

    schema = "y int, bins array<smallint>, margins array<double>"
    rows = materialize(labelled.select("y", _values(features)).mapInArrow(prepared, schema))
    for n in range(rounds):
        trees = [Tree.empty(depth) for _ in range(classes)]
        for level in range(depth):
            found = best_splits(_cells(rows, trees, level, width, bins), model.cuts, reg, least).collect()
            for r in found:
                _grow(trees[r["class"]], r, reg)
            if not any(r.feature is not None for r in found):
                break
        model.rounds.append(trees)
        if n + 1 < rounds:
            rows = materialize(rows.mapInArrow(_advance(model, trees), schema))
    return model


def _grow(tree: Tree, r, reg: float) -> None:
    tree.weight[r.node] = -r.g / (r.h + reg)
    if r.feature is not None:
        tree.feature[r.node], tree.bin[r.node], tree.missing_left[r.node] = r.feature, r.bin, r.missing_left
        tree.weight[2 * r.node + 1], tree.weight[2 * r.node + 2] = -r.gl / (r.hl + reg), -r.gr / (r.hr + reg)


def _advance(model: Model, trees: list[Tree]):
    """Add a round's trees to the margins of all rows."""
    step = Model(model.features, model.cuts, model.rate, [trees])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                b, m = _matrix(batch.column(1), np.int16), _matrix(batch.column(2), np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(m + step.margins(b, m.shape[1])), pa.list_(pa.float64()))],
                                                 ["y", "bins", "margins"])

    return run


def predict(df: DataFrame, model: Model, prediction: str = "prediction") -> DataFrame:
    """Append the class of the largest margin (ties to the smaller) to every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the parameters of the fit

    @F.pandas_udf("int")
    def classify(x):
        import pandas as pd
        if not len(x):
            return pd.Series([], dtype="int32")
        m = shared.value
        return pd.Series(m.margins(m.bins(np.stack(x.to_numpy())), len(m.rounds[0])).argmax(1).astype("int32"))

    return df.withColumn(prediction, classify(_values(model.features)))


def split_table(spark, model: Model, n: int = 0) -> DataFrame:
    """Round ``n`` as rows: class, path (0 left, 1 right), feature, threshold (null: only missing
    values go left), missing_left, weight_left, weight_right (before the learning rate)."""
    rows = []
    for k, tree in enumerate(model.rounds[n]):
        for i in np.flatnonzero(tree.feature >= 0).tolist():
            path, j = "", i
            while j:
                path, j = ("0" if j % 2 else "1") + path, (j - 1) // 2
            f = int(tree.feature[i])
            rows.append((k, path, model.features[f], float(model.cuts[f][tree.bin[i]]) if tree.bin[i] >= 0 else None, bool(tree.missing_left[i]),
                         float(tree.weight[2 * i + 1]), float(tree.weight[2 * i + 2])))
    return spark.createDataFrame(rows, "class int, path string, feature string, threshold double, missing_left boolean, weight_left double, weight_right double")
