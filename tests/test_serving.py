import datetime as dt

import pytest
from conftest import rows

from chainmetrics.operators import serving as S

D = dt.date


@pytest.fixture()
def catalogue(spark):
    return S.read_catalogue(spark)


def test_catalogue_shape(catalogue):
    assert catalogue.count() == 23
    assert catalogue.where("is_computed").count() == 15


def test_metric_search(catalogue):
    got = [r[0] for r in S.metric_search(catalogue, "price").collect()]
    assert set(got) == {"Price ($)", "Realised Price", "Transferred Price", "Balanced Price"}
    got = [r[0] for r in S.metric_search(catalogue, "REAL cap").collect()]
    assert got == ["Realised Capitalisation"]
    allnames = [r[0] for r in S.metric_search(catalogue, "").collect()]
    assert allnames == sorted(allnames) and len(allnames) == 23


def test_metric_lookup(catalogue):
    r = S.metric_lookup(catalogue, "Velocity").first()
    assert r["is_computed"] is True and r["column"] == "velocity"


def test_date_range_needs_both_bounds(spark):
    df = spark.createDataFrame([(D(2020, 1, d),) for d in range(1, 11)], "Date DATE")
    assert S.date_range(df, "2020-01-03", "2020-01-05").count() == 3
    assert S.date_range(df, "2020-01-03", None).count() == 10


def test_range_presets(spark):
    df = spark.createDataFrame([(D(2019, 12, 31),), (D(2020, 1, 15),), (D(2020, 6, 30),), (D(2020, 7, 31),)],
                               "Date DATE")
    assert rows(S.range_preset(df, "1M")) == [(D(2020, 6, 30),), (D(2020, 7, 31),)]
    assert len(rows(S.range_preset(df, "YTD"))) == 3
    assert len(rows(S.range_preset(df, "1Y"))) == 4
    assert len(rows(S.range_preset(df, "ALL"))) == 4


def test_ribbon_null_until_full(spark):
    df = spark.createDataFrame([(D(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(30)],
                               "Date DATE, difficulty DOUBLE")
    out = S.difficulty_ribbon(df).orderBy("Date").collect()
    assert all(r["d14"] is None for r in out[:13]) and out[13]["d14"] == pytest.approx(6.5)
    assert all(r["d40"] is None for r in out)  # series shorter than the window
    ranged = S.difficulty_ribbon(df, start="2020-01-10", end="2020-01-30").orderBy("Date").collect()
    assert ranged[12]["d14"] is None and ranged[13]["d14"] == pytest.approx(15.5)


def test_metric_series_dispatch(spark, catalogue):
    basic = spark.createDataFrame([(D(2020, 1, 1), 5.0, 7.0)], "Date DATE, price DOUBLE, tv_usd DOUBLE")
    comp = spark.createDataFrame([(D(2020, 1, 1), 9.0)], "Date DATE, velocity DOUBLE")
    got = rows(S.metric_series(catalogue, basic, comp, ["Price ($)", "Velocity"]))
    assert got == [(D(2020, 1, 1), "Price ($)", 5.0), (D(2020, 1, 1), "Velocity", 9.0)]
    assert rows(S.metric_series(catalogue, basic, comp)) == [(D(2020, 1, 1), "Price ($)", 5.0)]


def test_flagged_rows_and_page(spark):
    df = spark.createDataFrame([(i, i % 3, (i + 1) % 2, 0, 0, float(i)) for i in range(40)],
                               "account BIGINT, label INT, y_knn_pred INT, y_dtc_pred INT, y_xgb_pred INT, "
                               "value_usd DOUBLE")
    flagged = S.flagged_rows(df)
    assert flagged.count() == sum(1 for i in range(40) if i % 3 or (i + 1) % 2)
    page = S.illicit_accounts_page(flagged, "y_knn_pred", ["y_knn_pred", "account", "value_usd"], 10, 1)
    assert page.count() == 10
    with pytest.raises(ValueError):
        S.illicit_accounts_page(flagged, "y_knn_pred", page_size=7)


def test_outlier_series(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), 1.0, 2.0, 1), (D(2020, 1, 2), 3.0, 4.0, 0)],
                               "Date DATE, a DOUBLE, b DOUBLE, anomaly INT")
    got = rows(S.outlier_series(df, ["a", "b"]))
    assert got == [(D(2020, 1, 1), "a", 1.0, 1.0), (D(2020, 1, 1), "b", 2.0, 2.0),
                   (D(2020, 1, 2), "a", 3.0, None), (D(2020, 1, 2), "b", 4.0, None)]


def test_catalogue_from_shared_csv_equals_shipped(spark):
    a = S.read_catalogue(spark)
    b = S.read_catalogue(spark, S.CATALOGUE_CSV)
    assert sorted(a.collect()) == sorted(b.collect())


def test_metric_series_refuses_unknown_names(spark):
    import pytest
    catalogue = S.read_catalogue(spark)
    df = spark.createDataFrame([(D(2020, 1, 1), 5.0)], "Date DATE, price DOUBLE")
    for names in (["Nothing"], ["Price ($)", "Velocity"], [S.RIBBON_METRIC]):
        with pytest.raises(ValueError):
            S.metric_series(catalogue, df, df, names)


def test_keyset_page_equals_offset_page(spark):
    df = spark.createDataFrame([(i % 7, i, float(i % 5) if i % 11 else None) for i in range(200)], "y INT, account LONG, v DOUBLE")
    cols, order = ["y", "account", "v"], ["v", "y", "account"]
    by_number = S.illicit_accounts_page(df, "y", cols, 25, 3, order=order).collect()
    before = S.illicit_accounts_page(df, "y", cols, 25, 2, order=order).collect()[-1]
    assert S.illicit_accounts_page(df, "y", cols, 25, order=order, after=[before[c] for c in order]).collect() == by_number
