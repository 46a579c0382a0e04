"""Exact tree: the distributed splits, the local ones and a plain search agree."""

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from chainmetrics.operators import exact_tree as T

FEATURES = ("a", "b", "c")


def data(n=300, classes=3, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = [rng.choice([0.0, 1.0, 2.5]), round(rng.gauss(0, 1), 1), float(rng.randrange(5))]
        y = (int(x[0] > 1) + int(x[1] > 0.3) + (rng.random() < 0.1)) % classes
        out.append((i, *x, y))
    return out


def plain_tree(rows, classes):
    """{path: (feature, threshold, gain units) or class}: all thresholds, one by one."""
    def entropy(ys):
        return -sum(ys.count(k) / len(ys) * math.log2(ys.count(k) / len(ys)) for k in set(ys))

    out = {}

    def descend(path, part):
        ys = [r[-1] for r in part]
        best = None
        if len(set(ys)) > 1:
            for f in range(len(FEATURES)):
                values = sorted({r[1 + f] for r in part})
                for a, b in zip(values, values[1:]):
                    t = a + (b - a) / 2
                    low, high = [r[-1] for r in part if r[1 + f] <= t], [r[-1] for r in part if r[1 + f] > t]
                    gain = entropy(ys) - len(low) / len(ys) * entropy(low) - len(high) / len(ys) * entropy(high)
                    key = (math.floor(gain * 1e9 + 0.5), -f, -t)
                    best = max(best, key) if best else key
        if best is None:
            out[path] = min(set(ys), key=lambda k: (-ys.count(k), k))
            return
        f, t = -best[1], -best[2]
        out[path] = (f, t, best[0])
        descend(path + "0", [r for r in part if r[1 + f] <= t])
        descend(path + "1", [r for r in part if r[1 + f] > t])

    descend("", rows)
    return out


def as_paths(tree):
    """The tree table as {path: split or class}."""
    at = {(r.root, r.node): r for r in tree.collect()}
    out = {}

    def walk(path, key):
        r = at[key]
        if r.feature is None:
            out[path] = r.prediction
            return
        out[path] = (r.feature, r.threshold, round(r.gain * 1e9))
        for side, k in (("0", r.left), ("1", r.right)):
            walk(path + side, (r.root + side, 0) if k < 0 else (r.root, k))

    walk("", ("", 0))
    return out


@pytest.mark.parametrize("local_rows", [0, 60, 10_000])
def test_same_tree_however_it_is_grown(spark, local_rows):
    if local_rows == 0:
        sample = data(24, 2, 5)
        df, classes = spark.createDataFrame(sample, "id long, a double, b double, c double, label int"), 2
    else:
        sample = data()
        df, classes = spark.createDataFrame(sample, "id long, a double, b double, c double, label int"), 3
    tree = T.fit(df.repartition(3), FEATURES, classes=classes, local_rows=local_rows, blocks=4)
    want = plain_tree(sample, classes)
    assert as_paths(tree) == want
    assert tree.where("left = -1").count() == {0: sum(isinstance(v, tuple) for v in want.values()), 60: tree.where("left = -1").count(), 10_000: 0}[local_rows]

    def walk(r, path=""):
        v = want[path]
        return v if not isinstance(v, tuple) else walk(r, path + ("0" if r[1 + v[0]] <= v[1] else "1"))

    expected = sorted((r[0], walk(r)) for r in sample)
    assert rows(T.predict(df, tree, FEATURES, "p"), "id", "p") == expected
    if local_rows == 60:
        assert rows(T._predict_by_joins(df, tree, FEATURES, "p"), "id", "p") == expected


def test_edges(spark):
    schema = "a double, b double, c double, label int"
    same = spark.createDataFrame([(1.0, None, float("nan"), 1), (1.0, 0.0, 0.0, 1), (1.0, 0.0, None, 0), (9.0, 9.0, 9.0, None), (9.0, 9.0, 9.0, 7)], schema)
    tree = T.fit(same, FEATURES)
    assert [(r.n, r.prediction) for r in tree.collect()] == [(3, 1)]
    assert T.fit(same, FEATURES, levels=2).count() == 1
    empty = T.fit(same.limit(0), FEATURES)
    assert empty.count() == 0
    assert T.predict(same, empty, FEATURES).where("prediction is null").count() == 5
    deep = spark.createDataFrame([(float(i), 0.0, 0.0, i % 2) for i in range(200)], schema)
    assert T.predict(deep, T.fit(deep, FEATURES), FEATURES).where(F.col("prediction") != F.col("label")).count() == 0
    near = spark.createDataFrame([(1.0, 0.0, 0.0, 0), (1.0 + 2**-52, 0.0, 0.0, 1)], schema)
    assert T.predict(near, T.fit(near, FEATURES), FEATURES).where(F.col("prediction") != F.col("label")).count() == 0


def test_large_nodes_need_few_values(spark):
    """Bins only save work: the split of a large node is the best of all thresholds, and
    a tree too large to broadcast predicts as the broadcast one does."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(3000, 3)), 3)
    y = (rng.random(3000) < 0.5).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(k)) for r, k in zip(x, y)], "a double, b double, c double, label int")
    local = T.grow(x, y, 2)
    tree = T.fit(df, FEATURES, local_rows=700, blocks=64)
    assert tree.where("n = 3000").select("feature", "threshold").first() == (int(local[1][0]), float(local[2][0]))
    assert tree.where("left = -1").count() > 3 and tree.agg(F.max("n")).first()[0] == 3000
    assert T._predict_by_roots(df, tree, FEATURES, "p", share_rows=50).where("p <> label").count() == 0
