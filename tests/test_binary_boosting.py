import numpy as np
import pytest
from chainmetrics.operators import binary_boosting as BB
from chainmetrics.operators import classify as C
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F


def _rows(spark, n=1500, seed=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.integers(0, 5, n).astype(float), rng.exponential(size=n)
    y = ((a * b > 0.5) ^ (c > 1) ^ (rng.random(n) < 0.1)).astype(int)
    data = [(i, *map(float, v), int(w)) for i, (v, w) in enumerate(zip(zip(a, b, c), y))]
    return spark.createDataFrame(data, "id BIGINT, a DOUBLE, b DOUBLE, c DOUBLE, label INT")


def _mllib(df, rounds):
    """Margins of MLlib's booster by id."""
    steps = [VectorAssembler(inputCols=["a", "b", "c"], outputCol="_x"),
             GBTClassifier(featuresCol="_x", maxIter=rounds, stepSize=0.5, maxDepth=6, seed=0)]
    out = Pipeline(stages=steps).fit(df).transform(df)
    return {r.id: r.m for r in out.select("id", vector_to_array("rawPrediction")[1].alias("m")).collect()}


def test_margins_are_mllibs(spark, monkeypatch):
    """The same bins, trees and weights as MLlib's GBTClassifier, also over several blocks and cut lineages."""
    monkeypatch.setattr(BB, "BLOCK_ROWS", 400)
    monkeypatch.setattr(BB, "CHECKPOINT_ROUNDS", 3)
    df = _rows(spark).repartition(5).localCheckpoint()
    model = C.fit_boosted(df, ["a", "b", "c"], rounds=8)
    got = df.orderBy("id").toPandas()
    want = _mllib(df, 8)
    assert len(model.trees) == 8
    np.testing.assert_allclose(model.margins(got[["a", "b", "c"]].to_numpy()), [want[i] for i in got["id"]], atol=1e-9)
    out = C.apply_model(model, df, "y_xgb_pred")
    assert out.dtypes == [*df.dtypes, ("y_xgb_pred", "int")]
    assert {r.id: r.y_xgb_pred for r in out.collect()} == {i: int(m > 0) for i, m in want.items()}


def test_bins_of_a_sample_are_mllibs(spark):
    """Above 10,000 rows the bins come from MLlib's own draw."""
    df = _rows(spark, 25_000).repartition(4).localCheckpoint()
    model = C.fit_boosted(df, ["a", "b", "c"], rounds=3)
    got, want = df.toPandas(), _mllib(C._few_parts(df), 3)
    np.testing.assert_allclose(model.margins(got[["a", "b", "c"]].to_numpy()), [want[i] for i in got["id"]], atol=1e-9)


def test_one_pass_a_level_over_packed_rows(spark):
    """A round runs one job for each level of its tree, over blocks of rows; MLlib's booster runs over the rows one by one."""
    df = _rows(spark).localCheckpoint()
    spark.sparkContext.setJobGroup("fit", "boosted trees")
    model = C.fit_boosted(df, ["a", "b", "c"], rounds=4)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fit"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert isinstance(model, BB.Model) and len(model.trees) == 4 and jobs <= 4 * 6 + 6


def test_odd_rows(spark):
    """Null and NaN features count as largest; labels other than 0 and 1, or none, are refused."""
    data = [(float("nan") if i % 3 == 0 else None if i % 3 == 1 else float(i), int(i % 3 < 2)) for i in range(90)]
    df = spark.createDataFrame(data, "a DOUBLE, label INT")
    out = C.apply_model(C.fit_boosted(df, ["a"], rounds=2), df, "y_xgb_pred")
    assert out.where("y_xgb_pred <> label").count() == 0
    same = C.fit_boosted(df.withColumn("label", F.lit(0)), ["a"], rounds=2)
    assert same.margins(np.array([[1.0], [np.nan]])).max() < 0
    for bad in (df.limit(0), df.withColumn("label", F.lit(2)), df.withColumn("label", F.lit(None).cast("int"))):
        with pytest.raises(ValueError, match="training rows"):
            C.fit_boosted(bad, ["a"], rounds=2)


def test_boosted_trees_are_stored_and_loaded(spark, tmp_path):
    df = _rows(spark, 300)
    model = C.fit_boosted(df, ["a", "b", "c"], rounds=3)
    C.save_model(model, str(tmp_path / "model"))
    again = C.load_model(str(tmp_path / "model"))
    x = np.array(df.select("a", "b", "c").collect(), float)
    assert again.features == model.features and (again.margins(x) == model.margins(x)).all()
