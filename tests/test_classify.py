import numpy as np
import pytest
from conftest import rows

from chainmetrics.operators import classify as C
from chainmetrics.session import scratch_path


def brute_knn(train, queries, k=4):
    out = {}
    for qid, qx in queries:
        d = sorted((float(np.sqrt(((np.array(qx) - np.array(tx)) ** 2).sum())), tid, lab) for tid, tx, lab in train)
        top = d[:k]
        if any(x[0] == 0 for x in top):
            w = {}
            for dist, _, lab in top:
                w[lab] = w.get(lab, 0) + (1.0 if dist == 0 else 0.0)
        else:
            w = {}
            for dist, _, lab in top:
                w[lab] = w.get(lab, 0) + 1.0 / dist
        out[qid] = min(w, key=lambda lab: (-w[lab], lab))
    return out


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_knn_equals_brute_force(spark, block_rows):
    rng = np.random.RandomState(3)
    train = [(i, rng.normal(size=3).round(2).tolist(), int(rng.randint(3))) for i in range(60)]
    queries = [(100 + i, rng.normal(size=3).round(2).tolist()) for i in range(25)]
    queries.append((500, train[5][1]))  # zero-distance neighbour
    tdf = spark.createDataFrame(train, "id BIGINT, x ARRAY<DOUBLE>, label INT")
    qdf = spark.createDataFrame(queries, "id BIGINT, x ARRAY<DOUBLE>")
    got = dict(rows(C.knn_classify(tdf, qdf, "x", "label", "id", block_rows=block_rows), "id", "prediction"))
    assert got == brute_knn(train, queries)
    assert got[500] == train[5][2]


def test_knn_tie_goes_to_smaller_label(spark):
    train = spark.createDataFrame([(1, [1.0], 1), (2, [-1.0], 0), (3, [5.0], 1), (4, [-5.0], 0)],
                                  "id BIGINT, x ARRAY<DOUBLE>, label INT")
    q = spark.createDataFrame([(9, [0.0])], "id BIGINT, x ARRAY<DOUBLE>")
    assert C.knn_classify(train, q, "x", "label", "id").first()["prediction"] == 0


def test_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0, True), (0, 0, False), (1, 1, False)], "y INT, p INT, is_train BOOLEAN")
    r = C.classification_report(df, "y", "p", "is_train", "m").first()
    assert (r["train_acc"], r["train_precision"], r["train_recall"], r["train_f1score"]) == (1.0, 0.0, 0.0, 0.0)
    assert (r["test_acc"], r["test_precision"], r["test_recall"], r["test_f1score"]) == (1.0, 1.0, 1.0, 1.0)


def test_trees_separable_and_persistence(spark):
    rng = np.random.RandomState(5)
    data = [(i, float(x), float(rng.normal()), int(x > 0)) for i, x in enumerate(rng.normal(size=400))]
    df = spark.createDataFrame(data, "id BIGINT, a DOUBLE, b DOUBLE, label INT")
    tree = C.fit_tree(df, ["a", "b"])
    boosted = C.fit_boosted(df, ["a", "b"], rounds=10)
    scored = C.score_all_models(df, df, ["a", "b"], "label", "id", tree, boosted)
    for p in ("y_dtc_pred", "y_xgb_pred", "y_knn_pred"):
        acc = scored.where(f"{p} = label").count() / 400
        assert acc > 0.95, p
    path = scratch_path(spark, "model")
    C.save_model(tree, path)
    again = C.apply_model(C.load_model(path), df, "y_dtc_pred")
    assert rows(again, "id", "y_dtc_pred") == rows(C.apply_model(tree, df, "y_dtc_pred"), "id", "y_dtc_pred")


def test_knn_repeated_ids_and_rows(spark):
    """Each query row is judged on its own, however often its id or its features repeat."""
    train = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 1), (3, [1.1], 1), (4, [1.2], 1), (5, [9.0], 0)],
                                  "id BIGINT, x ARRAY<DOUBLE>, label INT")
    one = spark.createDataFrame([(7, [0.9])], "id BIGINT, x ARRAY<DOUBLE>")
    four = spark.createDataFrame([(7, [0.9])] * 4 + [(7, [9.0]), (None, [9.0])], "id BIGINT, x ARRAY<DOUBLE>")
    want = C.knn_classify(train, one, "x", "label", "id").first()["prediction"]
    got = [(r.x[0], r.prediction) for r in C.knn_classify(train, four, "x", "label", "id").collect()]
    assert sorted(got) == [(0.9, want)] * 4 + [(9.0, 0)] * 2


def test_knn_nulls_count_as_zero(spark):
    train = spark.createDataFrame([(1, 0.0, 5.0, 1), (2, 3.0, 5.0, 0), (3, 4.0, 5.0, 0)], "id BIGINT, a DOUBLE, b DOUBLE, label INT")
    q = spark.createDataFrame([(9, None, 5.0), (10, float("nan"), 5.0)], "id BIGINT, a DOUBLE, b DOUBLE")
    assert [r.prediction for r in C.knn_classify(train, q, ["a", "b"], "label", "id").collect()] == [1, 1]
    assert C.knn_classify(train.limit(0), q, ["a", "b"], "label", "id").where("prediction is null").count() == 2


def test_knn_plan_has_no_shuffle(spark):
    train = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 1)], "id BIGINT, x ARRAY<DOUBLE>, label INT")
    q = spark.range(100).selectExpr("id", "array(cast(id as double)) as x")
    plan = C.knn_classify(train, q, "x", "label", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_stored_models_give_the_same_predictions(spark):
    rng = np.random.RandomState(6)
    df = spark.createDataFrame([(i, float(x), int(x > 0)) for i, x in enumerate(rng.normal(size=200))], "id BIGINT, a DOUBLE, label INT")
    tree, boosted = C.fit_tree(df, ["a"]), C.fit_boosted(df, ["a"], rounds=3)
    path = scratch_path(spark, "store")
    C.store_models(path, df, tree, boosted)
    train, t2, b2 = C.load_models(spark, path)
    cols = ("id", "y_knn_pred", "y_dtc_pred", "y_xgb_pred")
    assert rows(C.score_all_models(df, train, ["a"], "label", "id", t2, b2), *cols) == rows(C.score_all_models(df, df, ["a"], "label", "id", tree, boosted), *cols)
    few = C.bounded_training_rows(df, "id", 50)
    assert 20 < few.count() < 90 and rows(few, "id") == rows(C.bounded_training_rows(df, "id", 50), "id")


def test_boxes_leave_out_what_is_farther():
    """The nearest of a block, found with a small part of its rows compared."""
    rng = np.random.default_rng(4)
    x, ids = np.round(rng.normal(size=(5000, 3)), 1), rng.permutation(5000)
    block = C._Block(x, ids, ids % 2, 4)
    q = np.round(rng.normal(size=(60, 3)), 1)
    at, dist, compared = block.search(q)
    for i in range(len(q)):
        want = sorted(zip(np.sqrt(((x - q[i]) ** 2).sum(1)).tolist(), ids.tolist()))[:4]
        assert list(zip(dist[i].tolist(), block.ids[at[i]].tolist())) == want
    assert compared.mean() < 0.3 * len(x)


def test_blocks_are_one_pass(spark):
    """However many blocks, the query rows go through one Python worker."""
    train = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(40)], "id BIGINT, x ARRAY<DOUBLE>, label INT")
    out = C.knn_classify(train, train, "x", "label", "id", block_rows=5)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert out.where("prediction = label").count() == 40
