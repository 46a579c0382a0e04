"""Property tests: the Spark operators against brute-force definitions on random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chainmetrics.operators import incremental as INC
from chainmetrics.operators import utxo as U

D0 = dt.date(2020, 1, 1)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@st.composite
def outputs(draw):
    n = draw(st.integers(1, 25))
    rows = []
    for i in range(n):
        c = draw(st.integers(0, 20))
        life = draw(st.one_of(st.none(), st.integers(0, 10)))
        v = draw(st.integers(1, 50))
        rows.append((i, D0 + dt.timedelta(days=c), None if life is None else D0 + dt.timedelta(days=c + life),
                     float(v), float(v * 10)))
    return rows


@SETTINGS
@given(outputs())
def test_realised_cap_equals_interval_join(spark, rows):
    df = spark.createDataFrame(rows, "hash BIGINT, created DATE, spent DATE, value_btc DOUBLE, value_usd DOUBLE")
    got = {r["Date"]: (r["rc_usd"], r["rc_btc"]) for r in U.realised_cap(df).collect()}
    for day, (usd, btc) in got.items():
        live = [r for r in rows if r[1] <= day and (r[2] is None or r[2] >= day)]
        assert usd == sum(r[4] for r in live) and btc == sum(r[3] for r in live)
    expected_days = {r[1] for r in rows} | {r[2] + dt.timedelta(days=1) for r in rows if r[2] is not None}
    assert set(got) == expected_days


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(-5, 5)), max_size=20),
       st.lists(st.tuples(st.integers(0, 30), st.integers(-5, 5)), max_size=20))
def test_upsert_newest_wins_and_idempotent(spark, old, new):
    old = {d: v for d, v in old}
    new = {d: v for d, v in new}
    schema = "Date DATE, x INT"
    a = spark.createDataFrame([(D0 + dt.timedelta(days=d), v) for d, v in old.items()], schema)
    b = spark.createDataFrame([(D0 + dt.timedelta(days=d), v) for d, v in new.items()], schema)
    once = {r[0]: r[1] for r in INC.upsert_daily(a, b).collect()}
    want = {D0 + dt.timedelta(days=d): v for d, v in {**old, **new}.items()}
    assert once == want
    twice = {r[0]: r[1] for r in INC.upsert_daily(INC.upsert_daily(a, b), b).collect()}
    assert twice == want
