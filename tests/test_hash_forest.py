"""Isolation forest with hash draws against a recursive version in plain Python."""

import hashlib
import math
import random

import pytest

from chainmetrics.operators import hash_forest as HF
from chainmetrics.operators.isoforest import EULER_GAMMA


def draw(*parts):
    return (int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) + 0.5) / 2**32


def excess(n):
    return 2 * (math.log(n - 1) + EULER_GAMMA) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def plain(rows, trees, sample):
    limit = math.ceil(math.log2(sample))

    def path(tree, members, x, node=1, depth=0):
        lo, hi = ([f(m[i] for m in members) for i in range(2)] if members else [0, 0] for f in (min, max))
        free = [i for i in range(2) if hi[i] > lo[i]]
        if depth == limit or not free:
            return depth + excess(len(members))
        f = free[math.floor(draw("feature", tree, node) * len(free))]
        split = lo[f] + draw("split", tree, node) * (hi[f] - lo[f])
        right = x[f] >= split
        return path(tree, [m for m in members if (m[f] >= split) == right], x, 2 * node + right, depth + 1)

    out = {}
    samples = [[x for i, x in rows.items() if draw("row", t, i) < sample / len(rows)] for t in range(trees)]
    for i, x in rows.items():
        out[i] = 2 ** (-sum(path(t, samples[t], x) for t in range(trees)) / trees / excess(sample))
    return out


@pytest.mark.parametrize("n, sample", [(60, 16), (12, 16)])
def test_same_as_plain_python(spark, n, sample):
    r = random.Random(n)
    rows = {i: (float(r.randint(0, 8)), r.gauss(0, 1)) for i in range(n - 1)} | {n - 1: (50.0, 9.0)}
    df = spark.createDataFrame([(i, *x) for i, x in rows.items()], "id long, a double, b double").repartition(3)
    nodes = HF.grow(df, ["a", "b"], "id", trees=6, sample=sample)
    got = {q.id: q.score for q in HF.score_rows(df, nodes, ["a", "b"], trees=6, sample=sample).collect()}
    want = plain(rows, 6, sample)
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in got)
    assert max(got, key=got.get) == n - 1


def test_nulls_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 2.0), (None, 5.0, 5.0), (3, None, 1.0), (4, float("nan"), 1.0)], "id long, a double, b double")
    got = HF.score_rows(df, HF.grow(df, ["a", "b"], "id", trees=3, sample=4), ["a", "b"], trees=3, sample=4).collect()
    assert len(got) == 5 and all((q.score is None) == (q.id in (3, 4)) for q in got)
    none = df.limit(0)
    assert HF.score_rows(none, HF.grow(none, ["a", "b"], "id", trees=3, sample=4), ["a", "b"], trees=3, sample=4).count() == 0
