"""The binned tree against MLlib's, however it is grown, stored and applied."""

import numpy as np
import pytest
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from chainmetrics.operators import binned_tree as BT
from chainmetrics.operators import classify as C
from chainmetrics.operators import exact_tree as T

FEATURES = ["a", "b", "c", "d"]


def frame(spark, n, classes=2, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([np.round(rng.normal(size=n), 2), rng.integers(0, 5, n), np.round(rng.gamma(1.0, 100.0, n), 1), rng.integers(-3, 60, n)], 1)
    y = ((x[:, 0] > 0.2).astype(int) + (x[:, 1] > 2) + (rng.random(n) < 0.2)) % classes
    data = [(i, *map(float, r), int(k)) for i, (r, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, label int").repartition(3)


def mllib(df, depth):
    stages = [VectorAssembler(inputCols=FEATURES, outputCol="v"), DecisionTreeClassifier(featuresCol="v", impurity="entropy", maxDepth=depth, seed=0)]
    return rows(Pipeline(stages=stages).fit(df).transform(df).withColumn("p", F.col("prediction").cast("int")), "id", "p")


@pytest.mark.parametrize("n,classes,depth,local_rows", [(2000, 2, 30, 500_000), (2000, 3, 30, 150), (2000, 2, 4, 150), (12_000, 2, 30, 1500)])
def test_same_classes_as_mllib(spark, n, classes, depth, local_rows):
    df = frame(spark, n, classes).cache()
    model = BT.fit(df, FEATURES, "label", depth, "p", local_rows=local_rows)
    got = rows(model.transform(df), "id", "p")
    assert got == mllib(df, depth)
    assert (model.tree.where("left = -1").count() > 1) == (local_rows < n)


def test_a_large_tree_stays_out_of_the_driver(spark, monkeypatch):
    """Trees beyond broadcasting predict where rows and nodes meet; none is collected."""
    df = frame(spark, 3000, seed=4)
    model = BT.fit(df, FEATURES, "label", 30, "p", local_rows=300)
    want = rows(model.transform(df), "id", "p")
    monkeypatch.setattr(T, "BROADCAST_NODES", 100)
    monkeypatch.setattr(T, "_Arrays", type("Never", (T._Arrays,), {"__init__": None}))
    assert rows(model.transform(df), "id", "p") == want


def test_edges(spark):
    schema = "a double, b double, c double, d double, label int"
    nulls = spark.createDataFrame([(None, 1.0, 1.0, 1.0, 1), (float("nan"), 1.0, 1.0, 1.0, 1), (0.0, 1.0, 1.0, 1.0, 0), (2.0, 1.0, 1.0, 1.0, 0)], schema)
    assert C.apply_model(C.fit_tree(nulls, FEATURES), nulls, "y_dtc_pred").where("y_dtc_pred <> label").count() == 0
    one = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, 0)] * 3, schema)
    assert C.fit_tree(one, FEATURES).tree.count() == 1
    tied = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, k % 2) for k in range(4)], schema)
    assert {r.y_dtc_pred for r in C.apply_model(C.fit_tree(tied, FEATURES), tied, "y_dtc_pred").collect()} == {0}
    for bad in (one.limit(0), nulls.withColumn("label", F.lit(-1))):
        with pytest.raises(ValueError):
            C.fit_tree(bad, FEATURES)
