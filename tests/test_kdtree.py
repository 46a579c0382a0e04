"""kd-tree kNN against all pairs, with equal rows, hot cells and little work on clustered data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainmetrics.operators import classify as C
from chainmetrics.operators import kdtree as K


def clustered(n, seed, spread=0.05, centres=12, d=3):
    rng = np.random.default_rng(seed)
    at = rng.uniform(-5, 5, (centres, d))
    which = rng.integers(0, centres, n)
    return [(i, [float(v) for v in np.round(at[c] + rng.normal(0, spread, d), 3)], int(c % 3)) for i, c in enumerate(which)]


def plain(train, queries, k):
    out = {}
    for q, x, _ in queries:
        near = sorted((float(np.sqrt(((np.array(x or [0.0] * 3) - np.array(t)) ** 2).sum())), i, y) for i, t, y in train)[:k]
        out[q] = near
    return out


@pytest.mark.parametrize("part_rows,share_rows,cells", [(50_000, 100_000, 32), (40, 25, 4)])
def test_equal_to_all_pairs_with_little_work(spark, part_rows, share_rows, cells):
    train, queries = clustered(600, 1), [(i + 5000, x, y) for i, x, y in clustered(150, 1)] + [(i + 7000, x, y) for i, x, y in clustered(50, 2)]
    train += [(9000 + i, train[0][1], 2) for i in range(80)]  # many equal rows in one cell
    queries += [(8000, None, 0)]
    schema = "id long, x array<double>, y int"
    got = K.nearest(spark.createDataFrame(train, schema), spark.createDataFrame(queries, schema).repartition(3), "x", "y", "id", 4, cells,
                    part_rows, share_rows).collect()
    assert len(got) == len(queries) and [f for f in got[0].__fields__] == ["id", "x", "y", "_nn", "n_distances"]
    want = plain(train, queries, 4)
    for r in got:
        assert [(n.tid, n.tlabel) for n in r._nn] == [(i, y) for _, i, y in want[r.id]]
        assert [n.dist for n in r._nn] == pytest.approx([d for d, *_ in want[r.id]])
    if cells == 32:
        assert sum(r.n_distances for r in got) < 0.2 * len(train) * len(queries)
        brute = C.knn_classify(spark.createDataFrame(train, schema), spark.createDataFrame(queries, schema), "x", "y", "id")
        tree = K.knn_classify(spark.createDataFrame(train, schema), spark.createDataFrame(queries, schema), "x", "y", "id")
        assert {r.id: r.prediction for r in tree.collect()} == {r.id: r.prediction for r in brute.collect()}


def test_edges(spark):
    schema = "id long, x array<double>, y int"
    few = spark.createDataFrame([(1, [1.0], 0), (2, [None], 1), (None, [0.0], 1), (3, [0.0], None)], schema)
    ask = spark.createDataFrame([(1, [1.0], 0), (1, [1.0], 0), (2, [float("nan"), 3.0], 0)], schema)
    got = K.knn_classify(few, ask, "x", "y", "id").collect()
    assert sorted((r.id, r.prediction, r.n_distances) for r in got) == [(1, 0, 2), (1, 0, 2), (2, 1, 2)]
    assert K.knn_classify(few.limit(0), ask, "x", "y", "id").where("prediction is null and n_distances = 0").count() == 3
    assert K.knn_classify(few, ask.limit(0), "x", "y", "id").count() == 0


def test_cells_of_equal_rows():
    tree = K.Cells.build(np.array([[1.0, 2.0]] * 50), 8, 2)
    assert (tree.dimension == -1).all()
    mixed = np.array([[0.0]] * 5 + [[7.0]] * 95)
    assert len(set(K.Cells.build(mixed, 8, 2).of(mixed).tolist())) == 2


def test_votes_of_rows_are_those_of_one():
    """The votes of many rows at once, with ties, neighbours at distance 0 and fewer than k of them."""
    rng = np.random.default_rng(8)
    dist, labels = np.sort(rng.integers(0, 4, (500, 4)).astype(float), axis=1), rng.integers(0, 3, (500, 4)).astype(np.int32)
    dist[::7, 2:] = np.inf
    want = [C.vote([{"dist": d, "tlabel": y} for d, y in zip(r, v) if np.isfinite(d)]) for r, v in zip(dist.tolist(), labels.tolist())]
    assert K.votes(dist, labels).tolist() == want


def test_equal_rows_are_searched_once():
    """However often a vector occurs, a block keeps the k smallest ids of it, and equal queries are one."""
    x = np.repeat([[1.0, 2.0], [3.0, 4.0]], 1000, axis=0)
    ids = np.random.default_rng(1).permutation(2000)
    block = C._Block(x, ids, ids % 2, 4)
    assert len(block.x) == 8
    at, dist, compared = block.search(np.array([[1.0, 2.0], [3.0, 4.5]]))
    assert block.ids[at].tolist() == [sorted(ids[:1000].tolist())[:4], sorted(ids[1000:].tolist())[:4]] and compared.max() <= 8
    some, of = K._distinct(x[::-1])
    assert some.tolist() == [[1.0, 2.0], [3.0, 4.0]] and (some[of] == x[::-1]).all()


def test_more_training_rows_make_more_cells(spark, monkeypatch):
    """Cells follow the number of training rows, so that none grows with the table."""
    monkeypatch.setattr(K, "CELLS", 4)
    made = []
    build = K.Cells.build.__func__
    monkeypatch.setattr(K.Cells, "build", classmethod(lambda cls, sample, cells, least: made.append(cells) or build(cls, sample, cells, least)))
    train = clustered(600, 1)
    df = spark.createDataFrame(train, "id long, x array<double>, y int")
    got = K.nearest(df, df, "x", "y", "id", 4, part_rows=50).collect()
    want = plain(train, train, 4)
    assert made == [24] and all([n.tid for n in r._nn] == [i for _, i, _ in want[r.id]] for r in got)
