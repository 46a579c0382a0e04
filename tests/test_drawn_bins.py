"""Boosted trees over bins from a draw of the training rows, against MLlib's."""

import numpy as np
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from chainmetrics.operators import classify as C

FEATURES = ["a", "b", "c", "d"]


def test_a_draw_may_make_a_bin_more(spark):
    """A draw of more rows than its share says makes 33 bins, as with MLlib; all are counted."""
    rng, n = np.random.default_rng(1), 12_000
    x = np.stack([np.round(rng.normal(size=n), 2), rng.integers(0, 5, n), np.round(rng.gamma(1.0, 100.0, n), 1), rng.integers(-3, 60, n)], 1)
    y = ((x[:, 0] > 0.2).astype(int) + (x[:, 1] > 2) + (rng.random(n) < 0.2)) % 2
    data = [(i, *map(float, r), int(k)) for i, (r, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "id long, a double, b double, c double, d double, label int").repartition(3).localCheckpoint()
    boosted = C.fit_boosted(df, FEATURES, rounds=2, max_depth=3)
    assert max(len(c) for c in boosted.cuts) == 32
    want = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="v"), GBTClassifier(featuresCol="v", maxIter=2, stepSize=0.5, maxDepth=3, seed=0)])
    want = rows(want.fit(C._few_parts(df)).transform(df).withColumn("p", F.col("prediction").cast("int")), "id", "p")
    assert rows(C.apply_model(boosted, df, "y_xgb_pred"), "id", "y_xgb_pred") == want
