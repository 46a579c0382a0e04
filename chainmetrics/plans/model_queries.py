"""Registered queries: classifiers, reports and flagged rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chainmetrics.operators import classify as C
from chainmetrics.operators import features as FE
from chainmetrics.operators import kdtree as KD
from chainmetrics.operators import serving as S
from chainmetrics.plans.label_queries import FEATURES as INPUT_FEATURES
from chainmetrics.plans.label_queries import labelled_inputs
from chainmetrics.plans.registry import VIEWS, register, with_views
from chainmetrics.plans.rounding import RATIO, round_all, sql_rnd
from chainmetrics.session import materialize, scratch_path

VIEWS.update({
    "emb": ("SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label, vec_id % 10 < 7 AS is_train "
            "FROM embeddings", ()),
    "knn_top": ("""
        SELECT * FROM (
          SELECT q.vec_id AS qid, t.vec_id AS tid, t.label AS tlabel, list_distance(q.x, t.x) AS dist,
                 row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.x, t.x), t.vec_id) AS rn
          FROM emb q, emb t WHERE t.is_train) WHERE rn <= 4""", ("emb",)),
    "knn_pred": ("""
        SELECT qid, tlabel AS prediction FROM (
          SELECT qid, tlabel, row_number() OVER (PARTITION BY qid ORDER BY w DESC, tlabel) AS r FROM (
            SELECT qid, tlabel, sum(CASE WHEN zero = 1 THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END
                                         ELSE 1.0 / dist END) AS w
            FROM (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) AS zero
                  FROM knn_top)
            GROUP BY qid, tlabel)) WHERE r = 1""", ("knn_top",)),
    "knn_out": ("""
        SELECT e.vec_id, e.label, e.is_train, p.prediction
        FROM emb e LEFT JOIN knn_pred p ON e.vec_id = p.qid""", ("emb", "knn_pred")),
    "knn_report": ("""
        SELECT 'knn' AS model,
          coalesce(sum(CASE WHEN is_train AND label = prediction THEN 1 END) * 1.0
                   / nullif(sum(CASE WHEN is_train THEN 1 END), 0), 0) AS train_acc,
          coalesce(sum(CASE WHEN is_train AND label = 1 AND prediction = 1 THEN 1 END) * 1.0
                   / nullif(sum(CASE WHEN is_train AND prediction = 1 THEN 1 END), 0), 0) AS train_precision,
          coalesce(sum(CASE WHEN is_train AND label = 1 AND prediction = 1 THEN 1 END) * 1.0
                   / nullif(sum(CASE WHEN is_train AND label = 1 THEN 1 END), 0), 0) AS train_recall,
          coalesce(2.0 * sum(CASE WHEN is_train AND label = 1 AND prediction = 1 THEN 1 END)
                   / nullif(sum(CASE WHEN is_train AND (label = 1 OR prediction = 1) THEN 1 END)
                            + sum(CASE WHEN is_train AND label = 1 AND prediction = 1 THEN 1 END), 0), 0)
            AS train_f1score,
          coalesce(sum(CASE WHEN NOT is_train AND label = prediction THEN 1 END) * 1.0
                   / nullif(sum(CASE WHEN NOT is_train THEN 1 END), 0), 0) AS test_acc,
          coalesce(sum(CASE WHEN NOT is_train AND label = 1 AND prediction = 1 THEN 1 END) * 1.0
                   / nullif(sum(CASE WHEN NOT is_train AND prediction = 1 THEN 1 END), 0), 0) AS test_precision,
          coalesce(sum(CASE WHEN NOT is_train AND label = 1 AND prediction = 1 THEN 1 END) * 1.0
                   / nullif(sum(CASE WHEN NOT is_train AND label = 1 THEN 1 END), 0), 0) AS test_recall,
          coalesce(2.0 * sum(CASE WHEN NOT is_train AND label = 1 AND prediction = 1 THEN 1 END)
                   / nullif(sum(CASE WHEN NOT is_train AND (label = 1 OR prediction = 1) THEN 1 END)
                            + sum(CASE WHEN NOT is_train AND label = 1 AND prediction = 1 THEN 1 END), 0), 0)
            AS test_f1score
        FROM knn_out""", ("knn_out",)),
})

REPORT_COLUMNS = ("train_acc", "train_precision", "train_recall", "train_f1score",
                  "test_acc", "test_precision", "test_recall", "test_f1score")
REPORT_SPEC = {c: RATIO for c in REPORT_COLUMNS}


def embeddings_knn(t):
    """kNN on the embedding vectors: train = vec_id % 10 < 7, every row predicted."""
    emb = FE.modulus_split(t.embeddings, "vec_id")
    train = emb.where("is_train")
    return C.knn_classify(train, emb, "embedding", "label", "vec_id").select(
        "vec_id", "label", "is_train", "prediction")


@register("knn_classify", with_views("SELECT vec_id, label, is_train, prediction FROM knn_out", "knn_out"))
def q_knn(t):
    return embeddings_knn(t)


@register("knn_kdtree", with_views("SELECT vec_id, label, is_train, prediction FROM knn_out", "knn_out"))
def q_knn_kdtree(t):
    """The same classes from a kd-tree of cells, for training sets beyond broadcasting."""
    emb = FE.modulus_split(t.embeddings, "vec_id")
    out = KD.knn_classify(emb.where("is_train"), emb, "embedding", "label", "vec_id", cells=16)
    return out.select("vec_id", "label", "is_train", "prediction")


@register("knn_kdtree_work", with_views("""
    SELECT label, count(*) AS n, true AS exact FROM labelled_inputs GROUP BY label""", "labelled_inputs"))
def q_knn_kdtree_work(t):
    """Nearest labelled training input of every labelled input over its coin value and lifespan: the
    cells leave under a fifth of all pairs to compare, and training rows find themselves or an equal."""
    df = split_inputs(t).select("hash", "label", "is_train", "value_btc", "lifespan")
    train = df.where("is_train")
    out = KD.nearest(train, df, ("value_btc", "lifespan"), "label", "hash", k=1)
    work = F.try_divide(F.sum("n_distances").over(Window.partitionBy()), F.lit(df.count() * train.count()))
    return (out.withColumn("few", work < 0.2).groupBy("label")
            .agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("few") & (~F.col("is_train") | (F.col("_nn")[0]["dist"] == 0))).alias("exact")))


@register("classification_report", with_views(
    "SELECT model, " + ", ".join(f"{sql_rnd(c, RATIO)} AS {c}" for c in REPORT_COLUMNS) + " FROM knn_report",
    "knn_report"))
def q_report(t):
    rep = C.classification_report(embeddings_knn(t), "label", "prediction", "is_train", "knn")
    return round_all(rep, REPORT_SPEC)


@register("model_performance", with_views(
    "SELECT model, " + ", ".join(f"{sql_rnd(c, RATIO)} AS {c}" for c in REPORT_COLUMNS if c.startswith("test"))
    + " FROM knn_report WHERE model = 'knn'", "knn_report"))
def q_model_performance(t):
    rep = C.classification_report(embeddings_knn(t), "label", "prediction", "is_train", "knn")
    return round_all(S.model_performance(rep, "knn"), REPORT_SPEC)


@register("flagged_rows", with_views(
    "SELECT vec_id, label, prediction AS y_knn_pred FROM knn_out WHERE label <> 0 OR prediction <> 0",
    "knn_out"))
def q_flagged_rows(t):
    out = embeddings_knn(t).select("vec_id", "label", F.col("prediction").alias("y_knn_pred"))
    return S.flagged_rows(out, ("label", "y_knn_pred"))


# -- labelled inputs: split by transaction, trees, all models ----------------------

SPLIT_SQL = "('0x' || substr(md5(CAST(hash AS VARCHAR)), 1, 8))::BIGINT % 10000 < 7000"


def split_inputs(t):
    """Labelled inputs, nulls filled, with a train flag by the md5 of the transaction hash;
    stored once for all fits and predictions."""
    return materialize(FE.md5_split(labelled_inputs(t), "hash", C.TRAIN_FRACTION))


@register("train_test_split", with_views(f"SELECT hash, account, label, {SPLIT_SQL} AS is_train FROM labelled_inputs", "labelled_inputs"))
def q_split(t):
    """Labelled inputs with a deterministic 70/30 train flag."""
    return split_inputs(t).select("hash", "account", "label", "is_train")


def _tree(t):
    df = split_inputs(t)
    return C.apply_model(C.fit_tree(df.where("is_train"), INPUT_FEATURES), df, "y_dtc_pred")


def _boosted(t):
    df = split_inputs(t)
    return C.apply_model(C.fit_boosted(df.where("is_train"), INPUT_FEATURES), df, "y_xgb_pred")


def _fit_store(t) -> tuple:
    """Fit the three models once on all training rows and store them."""
    df = split_inputs(t)
    train = df.where("is_train")
    path = scratch_path(t.spark, "models")
    C.store_models(path, train, C.fit_tree(train, INPUT_FEATURES), C.fit_boosted(train, INPUT_FEATURES))
    return df, path


def _scored(t):
    """All rows scored by the stored models, as a daily job would: load, then apply."""
    df, path = _fit_store(t)
    train, tree, boosted = C.load_models(t.spark, path)
    return C.score_all_models(df, train, INPUT_FEATURES, "label", "hash", tree, boosted)


TOTALS_SQL = f"SELECT {SPLIT_SQL} AS is_train, label, count(*) AS n, count(*) AS n_predicted FROM labelled_inputs GROUP BY 1, 2"


def _totals(df, prediction: str):
    """Rows and valid predictions by split and label: confusion cells sum to the label counts."""
    return df.groupBy("is_train", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(prediction).isin(0, 1)).alias("n_predicted"))


@register("decision_tree")
def q_decision_tree(t):
    return _tree(t).select("hash", "account", "label", "is_train", "y_dtc_pred")


@register("decision_tree_totals", with_views(TOTALS_SQL, "labelled_inputs"))
def q_decision_tree_totals(t):
    """Every labelled input is predicted once by the tree, and as 0 or 1."""
    return _totals(_tree(t), "y_dtc_pred")


@register("boosted_trees")
def q_boosted(t):
    return _boosted(t).select("hash", "account", "label", "is_train", "y_xgb_pred")


@register("score_all_models")
def q_score_all(t):
    """All three models on every labelled input; rows flagged by label or any model."""
    return S.flagged_rows(_scored(t)).select("hash", "account", "label", "is_train", "y_knn_pred", "y_dtc_pred", "y_xgb_pred")


@register("score_all_totals", with_views(TOTALS_SQL.replace("AS n_predicted", "AS n_predicted, count(*) AS n_trees, count(*) AS n_boosted"), "labelled_inputs"))
def q_score_all_totals(t):
    """Every labelled input gets a 0 or 1 from each of the three stored models."""
    return _scored(t).groupBy("is_train", "label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y_knn_pred").isin(0, 1)).alias("n_predicted"),
        F.count_if(F.col("y_dtc_pred").isin(0, 1)).alias("n_trees"), F.count_if(F.col("y_xgb_pred").isin(0, 1)).alias("n_boosted"))


@register("anomaly_results")
def q_anomaly_results(t):
    """Train/test report of the three models on the labelled inputs, one pass."""
    split, models = F.col("is_train"), (("dtc", "y_dtc_pred"), ("knn", "y_knn_pred"), ("xgb", "y_xgb_pred"))
    cells = [m.alias(f"{name}_{c}") for name, p in models for prefix, where in (("train_", split), ("test_", ~split))
             for m, c in zip(C.confusion_metrics("label", p, 1, prefix, where), [prefix + x for x in ("acc", "precision", "recall", "f1score")])]
    one = _scored(t).agg(*cells)
    rows = F.array(*[F.struct(F.lit(name).alias("model"), *[F.col(f"{name}_{c}").alias(c) for c in REPORT_COLUMNS]) for name, _ in models])
    return one.select(F.explode(rows).alias("r")).select("r.*")
