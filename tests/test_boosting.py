"""Softmax boosting against a plain version that tries every split of every round."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainmetrics.operators import boosting as B

FEATURES = ("a", "b", "c")
SCHEMA = "id long, a double, b double, c double, label int"


def data(n=220, classes=4, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), float(rng.randrange(6)), rng.random()
        y = (int(a > 0.2) + 2 * int(b > 2)) % classes if rng.random() < 0.9 else rng.randrange(classes)
        missing = rng.random()
        out.append((i, None if missing < 0.15 else a, float("nan") if 0.15 < missing < 0.25 else b, c, y))
    return out


def plain_margins(rows, cuts, classes, rounds, rate, depth, reg, least):
    """Margins after each round, by loops over rows and thresholds."""
    x = [[None if v is None or math.isnan(v) else v for v in r[1:4]] for r in rows]
    y = [r[4] for r in rows]
    margin = [[0.0] * classes for _ in rows]
    out = []
    for _ in range(rounds):
        step = [[0.0] * classes for _ in rows]
        for k in range(classes):
            g, h = [], []
            for m, t in zip(margin, y):
                e = [math.exp(v - max(m)) for v in m]
                p = e[k] / sum(e)
                g.append(p - (t == k))
                h.append(max(2 * p * (1 - p), 1e-16))

            def total(part):
                return sum(g[i] for i in part), sum(h[i] for i in part)

            def score(part):
                a, b = total(part)
                return a * a / (b + reg)

            def grow(part, level):
                best = None
                if level < depth:
                    for f in range(3):
                        for n, edge in enumerate([-math.inf, *cuts[f]], -1):
                            for left in (1, 0) if n >= 0 else (1,):
                                low = [i for i in part if (x[i][f] is None and left) or (x[i][f] is not None and x[i][f] <= edge)]
                                inside = set(low)
                                high = [i for i in part if i not in inside]
                                if total(low)[1] < least or total(high)[1] < least:
                                    continue
                                units = math.floor((score(low) + score(high) - score(part)) * 1e6 + 0.5)
                                key = (units, -f, -n, left)
                                if units > 0 and (best is None or key > best[0]):
                                    best = key, low, high
                if best:
                    grow(best[1], level + 1)
                    grow(best[2], level + 1)
                else:
                    a, b = total(part)
                    for i in part:
                        step[i][k] = rate * -a / (b + reg)

            grow(list(range(len(rows))), 0)
        margin = [[m + s for m, s in zip(a, b)] for a, b in zip(margin, step)]
        out.append(margin)
    return out


def test_three_rounds_equal_a_plain_version(spark):
    sample = data()
    df = spark.createDataFrame(sample, SCHEMA).repartition(3)
    options = dict(classes=4, rounds=3, rate=0.5, depth=2, reg=1.0, least=1.0)
    model = B.fit(df, FEATURES, bins=6, **options)
    want = plain_margins(sample, [c.tolist() for c in model.cuts], **options)
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in sample])
    bins = model.bins(x)
    for n in range(3):
        some = B.Model(model.features, model.cuts, model.rate, model.rounds[:n + 1])
        assert np.allclose(some.margins(bins, 4), want[n], atol=1e-9)
    got = {r.id: r.p for r in B.predict(df, model, "p").collect()}
    assert [got[r[0]] for r in sample] == np.argmax(want[-1], axis=1).tolist()
    assert sum(got[r[0]] == r[4] for r in sample) > 0.8 * len(sample)
    assert any(t.missing_left.any() for trees in model.rounds for t in trees)


def test_cuts_are_quantiles_of_present_values(spark):
    df = spark.createDataFrame(data(), SCHEMA).withColumn("c", F.lit(1.0))
    cuts = B.cut_points(df, FEATURES, 8)
    values = [r[1] for r in data() if r[1] is not None]
    assert np.allclose(cuts[0], np.quantile(values, [j / 8 for j in range(1, 8)]))
    assert cuts[2].tolist() == [1.0]
    some = B.cut_points(df, FEATURES, 8, rows=50)
    assert len(some[0]) == 7


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, 1.0, 2), (2, None, 1.0, 1.0, 2), (3, 1.0, 1.0, 1.0, None), (4, 0.0, 0.0, 0.0, 99)], SCHEMA)
    model = B.fit(df, FEATURES, classes=3, rounds=2, depth=2)
    assert {r.prediction for r in B.predict(df, model).collect()} == {2}
    assert B.split_table(spark, model).count() == 0
    none = B.fit(df.limit(0), FEATURES, classes=3, rounds=1, depth=2)
    assert {r.prediction for r in B.predict(df, none).collect()} == {0}
    with pytest.raises(IndexError):
        B.split_table(spark, none, 5)
