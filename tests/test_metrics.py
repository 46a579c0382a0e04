import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from chainmetrics.functions import chain as X
from chainmetrics.operators import metrics as M
from chainmetrics.operators import utxo as U

D = dt.date

OUT_SCHEMA = "hash BIGINT, account BIGINT, created DATE, spent DATE, value_btc DOUBLE, value_usd DOUBLE, " \
             "spending_value_usd DOUBLE, fee_usd DOUBLE"


@pytest.fixture()
def outputs(spark):
    data = [
        (1, 10, D(2020, 1, 1), D(2020, 1, 3), 2.0, 100.0, 120.0, 1.0),
        (1, 10, D(2020, 1, 1), None, 1.0, 50.0, 50.0, 0.5),        # unspent
        (2, 11, D(2020, 1, 2), D(2020, 1, 2), 3.0, 300.0, 330.0, 3.0),  # created and spent same day
        (3, 12, D(2020, 1, 3), D(2020, 1, 5), 4.0, 400.0, 360.0, 4.0),
    ]
    return spark.createDataFrame(data, OUT_SCHEMA)


def brute_realised_cap(out_rows, day):
    live = [r for r in out_rows if r[2] <= day and (r[3] is None or r[3] >= day)]
    return sum(r[5] for r in live), sum(r[4] for r in live)


def test_realised_cap_deltas_equal_interval_join(spark, outputs):
    got = {r["Date"]: (r["rc_usd"], r["rc_btc"]) for r in U.realised_cap(outputs).collect()}
    data = [tuple(r) for r in outputs.collect()]
    assert set(got) == {D(2020, 1, 1), D(2020, 1, 2), D(2020, 1, 3), D(2020, 1, 4), D(2020, 1, 6)}
    for day, val in got.items():
        assert val == pytest.approx(brute_realised_cap(data, day))
    # spent on the day still counts that day, gone the next
    assert got[D(2020, 1, 2)] == pytest.approx((450.0, 6.0))
    assert got[D(2020, 1, 4)] == pytest.approx((450.0, 5.0))


def test_realised_cap_spine_fills_quiet_days(spark, outputs):
    spine = spark.createDataFrame([(D(2020, 1, 5),), (D(2020, 1, 10),)], "Date DATE")
    got = {r["Date"]: r["rc_usd"] for r in U.realised_cap(outputs, spine).collect()}
    assert got[D(2020, 1, 5)] == pytest.approx(450.0)
    assert got[D(2020, 1, 10)] == pytest.approx(50.0)


def test_sopr_and_zero_divisor(spark, outputs):
    from chainmetrics.sources.adapters import spent_inputs
    zero = spark.createDataFrame([(9, 1, D(2020, 2, 1), D(2020, 2, 2), 1.0, 0.0, 5.0, 0.0)], OUT_SCHEMA)
    got = dict(rows(M.sopr(spent_inputs(outputs.unionByName(zero)))))
    assert got[D(2020, 1, 3)] == pytest.approx(120.0 / 100.0)
    assert got[D(2020, 1, 2)] == pytest.approx(1.1)
    assert got[D(2020, 2, 2)] is None  # zero creation value -> NULL, not an error


def test_fused_equals_per_metric_basic(spark):
    from chainmetrics.plans.metric_queries import TEST_GENESIS, basic_per_metric
    from chainmetrics.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    fused, _ = M.chain_metrics(t.lineitem, t.orders, TEST_GENESIS)
    per = basic_per_metric(t)
    a = {r["Date"]: r for r in fused.collect()}
    b = {r["Date"]: r for r in per.collect()}
    assert set(a) == set(b) and len(a) > 0
    for d in a:
        for c in M.BASIC_COLUMNS:
            assert a[d][c] == pytest.approx(b[d][c], rel=1e-9), (d, c)


def test_computed_invariants(spark):
    from chainmetrics.plans.metric_queries import TEST_GENESIS
    from chainmetrics.sources.tables import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    _, comp = M.chain_metrics(t.lineitem, t.orders, TEST_GENESIS)
    for r in comp.collect():
        if r["velocity"] is not None and r["nvt"] is not None:
            assert r["velocity"] * r["nvt"] == pytest.approx(1.0)
        assert r["balanced_price"] == pytest.approx(r["realised_price"] - r["transferred_price"])
        assert r["investor_cap"] == pytest.approx(r["realised_cap"] - r["thermocap"])


def test_running_sums_single_and_duplicate_free(spark):
    basic = spark.createDataFrame(
        [(D(2020, 1, 1), 2.0, 3, 1.0, 10.0), (D(2020, 1, 3), 4.0, 1, 2.0, 20.0)],
        "Date DATE, cost_per_tx DOUBLE, tx_count BIGINT, cdd DOUBLE, price DOUBLE")
    th = dict(rows(M.thermocap(basic)))
    assert th == {D(2020, 1, 1): 6.0, D(2020, 1, 3): 10.0}
    cc = {r["Date"]: (r["cum_cdd_usd"], r["n_days"]) for r in M.cumulative_cdd(basic, "2020-01-01").collect()}
    assert cc[D(2020, 1, 3)] == (50.0, 3)


def test_join_series_drops_missing_day(spark):
    a = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 1, 2), 2.0)], "Date DATE, a DOUBLE")
    b = spark.createDataFrame([(D(2020, 1, 2), 5.0)], "Date DATE, b DOUBLE")
    assert rows(M.join_series({"a": a, "b": b})) == [(D(2020, 1, 2), 2.0, 5.0)]


def test_display_names_and_units(spark):
    df = spark.createDataFrame([(D(2020, 1, 1), 1.0, 250_000_000)], "Date DATE, price DOUBLE, sat BIGINT")
    out = M.with_display_names(df)
    assert out.columns == ["Date", "Price ($)", "sat"]
    assert out.select(X.to_coins("sat")).first()[0] == 2.5
    assert df.select(X.day_number(F.lit(D(2009, 1, 3)))).first()[0] == 1


def test_duplicate_day_collapsed_before_running_sum(spark):
    basic = spark.createDataFrame(
        [(D(2020, 1, 1), 2.0, 3, 1.0, 10.0), (D(2020, 1, 1), 2.0, 3, 1.0, 10.0), (D(2020, 1, 2), 1.0, 1, 1.0, 1.0)],
        "Date DATE, cost_per_tx DOUBLE, tx_count BIGINT, cdd DOUBLE, price DOUBLE")
    assert dict(rows(M.thermocap(basic))) == {D(2020, 1, 1): 6.0, D(2020, 1, 2): 7.0}


def test_common_helpers(spark):
    from chainmetrics.functions import common as CM
    df = spark.createDataFrame([("03/01/2009", "x_knn_pred", True), ("2009-01-04", "y_dtc", False), ("bad", "z", None)],
                               "t STRING, n STRING, b BOOLEAN")
    out = df.select(CM.parse_day("t").alias("d"), CM.name_part("n").alias("m"), CM.flag_to_int("b").alias("i"),
                    CM.day_key(CM.parse_day("t")).alias("k")).collect()
    assert [r["d"] for r in out] == [D(2009, 1, 3), D(2009, 1, 4), None]
    assert [r["m"] for r in out] == ["knn", "dtc", None] and [r["i"] for r in out] == [1, 0, None]
    assert out[0]["k"] == "20090103"
    assert CM.feature_columns(spark.createDataFrame([(1, 2, 3)], "Date INT, b INT, a INT")) == ["a", "b"]
