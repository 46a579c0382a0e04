"""The registered models learn from all training rows."""

import pytest
from conftest import SF_SMALL

from chainmetrics.operators import classify as C
from chainmetrics.plans import QUERIES


@pytest.mark.parametrize("name", ["anomaly_results", "score_all_models", "score_all_totals"])
def test_models_learn_from_all_training_rows(spark, monkeypatch, name):
    """No sample, whatever the number of training rows: the store holds them all, and the trees are fitted to them."""
    seen, store = {}, C.store_models
    for fit in ("fit_tree", "fit_boosted"):
        monkeypatch.setattr(C, fit, lambda train, *a, _f=getattr(C, fit), _n=fit, **k: seen.setdefault(_n, train.count()) and _f(train, *a, **k))
    monkeypatch.setattr(C, "BOOST_ROUNDS", 2)
    monkeypatch.setattr(C.bounded_training_rows, "__defaults__", (50,))
    monkeypatch.setattr(C, "store_models", lambda path, train, *m: seen.setdefault("knn", train.count()) and store(path, train, *m))
    QUERIES[name](spark, SF_SMALL).count()
    want = QUERIES["train_test_split"](spark, SF_SMALL).where("is_train").count()
    assert seen == {"fit_tree": want, "fit_boosted": want, "knn": want} and want > 1000
