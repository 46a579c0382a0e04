import datetime as dt

import numpy as np
from pyspark.sql import functions as F
import pytest
from conftest import rows

from chainmetrics.operators import features as FE
from chainmetrics.operators import outliers as O

D = dt.date


@pytest.fixture()
def daily(spark):
    rng = np.random.RandomState(0)
    data = [(D(2020, 1, 1) + dt.timedelta(days=i), float(rng.normal(10, 2)), float(rng.normal(100, 5)), 3.0)
            for i in range(200)]
    return spark.createDataFrame(data, "Date DATE, a DOUBLE, b DOUBLE, c DOUBLE")


def test_standard_scale(daily):
    z = FE.standard_scale(daily, ["a", "b", "c"]).toPandas()
    assert z["a"].mean() == pytest.approx(0, abs=1e-9)
    assert z["a"].std(ddof=0) == pytest.approx(1.0)
    assert (z["c"] == 0).all()  # constant column


def test_minmax_scale(daily):
    m = FE.minmax_scale(daily, ["a", "c"]).toPandas()
    assert m["a"].min() == 0 and m["a"].max() == 1
    assert (m["c"] == 0).all()


def test_pca_orthonormal_and_variance(daily):
    mean, comps, ratio = FE.pca_fit(daily, ["a", "b"], 2)
    assert np.allclose(comps @ comps.T, np.eye(2))
    assert ratio.sum() == pytest.approx(1.0) and ratio[0] >= ratio[1]
    proj = FE.pca_project(daily, ["a", "b"], 2).toPandas()
    assert proj["pc1"].mean() == pytest.approx(0, abs=1e-9)
    assert FE.pca_report(daily, ["a", "b"]).count() == 2


def test_hash_split_deterministic(spark):
    df = spark.range(10000).withColumnRenamed("id", "k")
    a = FE.hash_split(df, "k").where("is_train").count()
    b = FE.hash_split(df.repartition(7), "k").where("is_train").count()
    assert a == b and 6700 < a < 7300


def test_nlargest_threshold_small_and_ties(spark):
    few = spark.createDataFrame([(float(i),) for i in range(19)], "s DOUBLE")
    r = O.contamination_threshold(few, "s").first()
    assert r["n"] == 0 and r["threshold"] is None
    assert O.flag_outliers(few, "s").where("anomaly = 1").count() == 0
    ties = spark.createDataFrame([(5.0,)] * 30 + [(1.0,)] * 10, "s DOUBLE")
    assert O.flag_outliers(ties, "s").where("anomaly = 1").count() == 30  # ties flagged together
    forty = spark.createDataFrame([(float(i),) for i in range(40)], "s DOUBLE")
    assert rows(O.flag_outliers(forty, "s").where("anomaly = 1"), "s") == [(38.0,), (39.0,)]


def test_percentile_threshold(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "s DOUBLE")
    r = O.contamination_threshold(df, "s", method="percentile").first()
    assert r["threshold"] == pytest.approx(95.0)


def test_centroid_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.9, 1.0), (5.0, 5.0)], "x DOUBLE, y DOUBLE")
    out = O.assign_centres(df, ["x", "y"], [(0, 0), (1, 1)]).orderBy("x").collect()
    assert [r["cluster"] for r in out] == [0, 1, 1, 1]
    assert out[0]["distance"] == 0 and out[-1]["distance"] == pytest.approx(np.sqrt(32))
    tie = O.assign_centres(spark.createDataFrame([(0.5, 0.5)], "x DOUBLE, y DOUBLE"), ["x", "y"], [(0, 0), (1, 1)])
    assert tie.first()["cluster"] == 0  # equal distance -> lower index


def test_kmeans_outliers_and_elbow(daily):
    out = O.kmeans_outliers(daily, ["a", "b"], k=3)
    assert out.count() == 200 and out.where("anomaly = 1").count() == 10
    assert set(r[0] for r in out.select("cluster").distinct().collect()) <= {0, 1, 2}
    elbow = O.kmeans_elbow(daily.select("a", "b"), ["a", "b"], ks=range(1, 5)).orderBy("k").collect()
    scores = [r["score"] for r in elbow]
    assert scores == sorted(scores)  # -SSE grows with k
    assert O.knee([(1, -10.0), (2, -3.0), (3, -2.0), (4, -1.5), (5, -1.2)]) == 2


def test_isolation_forest_finds_planted_outliers(spark):
    from chainmetrics.operators.isoforest import average_path_length, isolation_forest
    rng = np.random.RandomState(1)
    data = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, size=(500, 2)))]
    data += [(1000 + i, 8.0 + i, -8.0 - i) for i in range(5)]
    df = spark.createDataFrame(data, "id BIGINT, x DOUBLE, y DOUBLE")
    out = isolation_forest(df, ["x", "y"], trees=50, id_col="id").toPandas()
    planted = out[out["id"] >= 1000]
    assert (planted["anomaly"] == 1).all()
    assert out["anomaly"].sum() == pytest.approx(0.05 * len(out), abs=2)
    assert average_path_length([1, 2])[1] == 1.0


def test_autoencoder_flags_share(spark, daily):
    from chainmetrics.operators.autoencoder import autoencoder_outliers, gradients, init_params
    out = autoencoder_outliers(daily, ["a", "b"], epochs=20).toPandas()
    assert out["anomaly"].sum() == 10
    # analytic gradient matches a finite difference
    p = init_params((2, 3, 2), 0)
    x = np.array([[0.3, -0.2], [1.0, 0.5]])
    g, loss = gradients(p, x)
    eps = 1e-6
    p2 = [q.copy() for q in p]
    p2[0][0, 0] += eps
    _, loss2 = gradients(p2, x)
    assert (loss2 - loss) / eps == pytest.approx(g[0][0, 0], rel=1e-3, abs=1e-6)


def test_approx_threshold_matches_exact_on_distinct_scores(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1000)], "s DOUBLE")
    exact = O.flag_outliers(df, "s", method="percentile", strict=True).where("anomaly = 1").count()
    approx = O.flag_outliers(df, "s", method="approx", strict=True).where("anomaly = 1").count()
    assert exact == 50 and abs(approx - exact) <= 1


def test_order_statistics_are_exact(spark):
    import numpy as np
    from chainmetrics.operators import outliers as O
    rng = np.random.default_rng(3)
    for values in (rng.normal(size=5000).tolist(), rng.integers(0, 4, 5000).astype(float).tolist(), [1.0], [2.0] * 50):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 7, "s DOUBLE").repartition(4)
        want = sorted(values)
        ranks = sorted({0, len(want) // 3, len(want) - 1, int(0.95 * (len(want) - 1))})
        assert O.order_statistics(df, "s", ranks, len(want)) == [want[r] for r in ranks]


def test_distributed_cut_equals_the_window(spark):
    import numpy as np
    from pyspark.sql import functions as F
    from chainmetrics.operators import outliers as O
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(size=3000).round(2))] + [(9000, None)], "id LONG, s DOUBLE").repartition(3)
    for method in ("nlargest", "percentile"):
        a, b = (O.flag_outliers(df, "s", method=method, day_grain=g) for g in (False, True))
        assert sorted(r.id for r in a.where("anomaly = 1").collect()) == sorted(r.id for r in b.where("anomaly = 1").collect())
        ta, tb = (O.contamination_threshold(df, "s", method=method, day_grain=g).first() for g in (False, True))
        assert (ta.n, round(ta.threshold, 9)) == (tb.n, round(tb.threshold, 9))
    plan = O.flag_outliers(df, "s")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    assert O.flag_outliers(df.limit(0), "s").count() == 0
    assert O.flag_outliers(df.where(F.col("id") < 5), "s").where("anomaly = 1").count() == 0


def test_kmeans_converges_and_knee(spark):
    import numpy as np
    from chainmetrics.operators import outliers as O
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([tuple(map(float, rng.normal(size=2) + 4 * (i % 3))) for i in range(600)], "a DOUBLE, b DOUBLE").cache()
    for k in (3, 4, 5):
        assert O.kmeans_fit(df, ["a", "b"], k).summary.numIter < O.KMEANS_ITERATIONS
    assert O.knee([(r.k, r.score) for r in O.kmeans_elbow(df, ["a", "b"], range(1, 8)).collect()]) in (2, 3)


def test_autoencoder_stops_and_lowers_the_loss(spark):
    import numpy as np
    from chainmetrics.operators import autoencoder as AE
    rng = np.random.default_rng(6)
    base = rng.normal(size=(400, 2))
    x = np.column_stack((base, base @ np.array([[1, 2, -1], [0.5, -1, 1]]))) 
    x = (x - x.mean(0)) / x.std(0)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE").repartition(3).cache()

    def loss(params):
        return float(((AE.forward(params, x)[-1] - x) ** 2).mean())

    start = loss(AE.init_params((5, *AE.HIDDEN, 5), 42))
    assert loss(AE.fit_autoencoder(df, list("abcde"), epochs=40)) < 0.7 * min(start, 1.0)


def plain_knees(points, sensitivity=1.0):
    pts = sorted(points)
    xs, ys = [p[0] for p in pts], [p[1] for p in pts]
    d = [round((y - min(ys)) / (max(ys) - min(ys)) - (x - min(xs)) / (max(xs) - min(xs)), 9) for x, y in pts]
    tops = [i for i in range(1, len(d) - 1) if d[i] > d[i - 1] and d[i] >= d[i + 1]]
    return [(xs[i], d[i]) for i, j in zip(tops, [*tops[1:], len(d)]) if min(d[i:j]) < d[i] - sensitivity / (len(d) - 1)]


def test_knees_of_curves(spark):
    one = [(k, -100 / k) for k in range(1, 20)]
    two = [(k, min(k, 5) * 3.0 + max(0, k - 30) * 2.0 - max(0, k - 35) * 1.9) for k in range(60)]  # two maxima
    flat, short = [(k, 1.0) for k in range(9)], [(0, 0.0), (1, 1.0)]
    data = [(name, x, float(y)) for name, pts in (("one", one), ("two", two), ("flat", flat), ("short", short)) for x, y in pts]
    df = spark.createDataFrame(data, "c string, x int, y double").repartition(4)
    got = sorted((r.c, r.x, round(r.height, 6)) for r in O.knees(df, by=("c",)).collect())
    want = sorted((c, x, round(h, 6)) for c, pts in (("one", one), ("two", two)) for x, h in plain_knees(pts))
    assert got == want and len([g for g in got if g[0] == "two"]) == 2
    assert O.knee(one) == plain_knees(one)[0][0] and O.knee(two) == plain_knees(two)[0][0] and O.knee(flat) is None


def test_range_cut_from_sketches(spark):
    rng = np.random.RandomState(2)
    data = [(f"2020-01-{1 + i % 28:02d}", float(v)) for i, v in enumerate(np.round(rng.normal(0, 10, 3000), 2))] + [("2020-01-05", 7.0)] * 400 + [("2020-01-09", None)]
    df = spark.createDataFrame(data, "d string, s double").select(F.col("d").cast("date").alias("Date"), "s")
    sketches = O.day_sketches(df, "s")
    for a, b, f in (("2020-01-01", "2020-01-31", 0.05), ("2020-01-04", "2020-01-06", 0.3), ("2020-01-10", "2020-01-10", 0.5), ("2020-01-01", "2020-01-31", 1.0), ("2021-01-01", "2021-01-02", 0.05)):
        mine = sorted((v for d, v in data if a <= d <= b and v is not None), reverse=True)
        n = int(f * len(mine))
        assert O.range_cut(df, sketches, "s", a, b, f) == (n, mine[n - 1] if n else None)
