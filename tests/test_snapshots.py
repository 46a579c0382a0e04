"""Snapshots of several tables, and the realised cap carried on them."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from chainmetrics.operators import open_outputs as OO
from chainmetrics.operators import utxo as U
from chainmetrics.session import local_path, scratch_path
from chainmetrics.sources.snapshots import Change, Snapshots

D = dt.date


@pytest.fixture
def store(spark):
    return Snapshots(spark, local_path(scratch_path(spark, "store")))


def table(spark, data, month=True):
    df = spark.createDataFrame(data, "k int, month string")
    return Change(df, F.col("month") if month else None)


def test_parts_are_replaced_and_versions_kept(spark, store):
    assert store.version() == 0 and not store.has("a")
    store.commit({"a": table(spark, [(1, "01"), (2, "02")]), "b": table(spark, [(9, "01")], month=False)})
    store.commit({"a": table(spark, [(20, "02"), (30, "03")])})
    assert rows(store.read("a"), "k") == [(1,), (20,), (30,)]
    assert rows(store.read("a", version=1), "k") == [(1,), (2,)]
    assert rows(store.read("b"), "k") == [(9,)]
    some = store.read("a", ["01", "03"])
    assert rows(some, "k") == [(1,), (30,)] and not any("_part=02" in f for f in some.inputFiles())
    # A touched part without rows goes; an empty table keeps its schema.
    store.commit({"a": Change(spark.createDataFrame([], "k int, month string"), F.col("month"), touched=["01"]), "b": Change(store.read("b").limit(0), whole=True)})
    assert rows(store.read("a"), "k") == [(20,), (30,)]
    assert store.read("b").columns == ["k", "month"] and store.read("b").count() == 0
    assert store.vacuum(keep=1) >= 2
    assert rows(store.read("a"), "k") == [(20,), (30,)]
    with pytest.raises(Exception):
        store.read("a", version=1).count()


def test_a_load_broken_between_tables_shows_the_old_snapshot(spark, store):
    store.commit({"a": table(spark, [(1, "01")]), "b": table(spark, [(1, "01")])})
    fail = F.udf(lambda k: 1 // 0, "int")
    broken = Change(spark.createDataFrame([(2, "01")], "k int, month string").withColumn("k", fail("k")), F.col("month"))
    with pytest.raises(Exception):
        store.commit({"a": table(spark, [(2, "01"), (2, "02")]), "b": broken})
    assert store.version() == 1
    assert rows(store.read("a"), "k") == rows(store.read("b"), "k") == [(1,)]
    for _ in range(2):  # a rerun, and one more
        store.commit({"a": table(spark, [(2, "01"), (2, "02")]), "b": table(spark, [(2, "01")])})
    assert rows(store.read("a"), "k", "month") == [(2, "01"), (2, "02")]
    assert rows(store.read("b"), "k") == [(2,)]


def test_of_two_writers_one_fails(spark, store):
    store.commit({"a": table(spark, [(1, "01")])})
    other = Snapshots(spark, store.root)
    publish = other._publish
    # The other one commits while this one is writing.
    store._publish, done = (lambda version, text, mine=store._publish: (publish(version, text), mine(version, text))), []
    with pytest.raises(RuntimeError, match="another writer"):
        store.commit({"a": table(spark, [(2, "01")])})
    assert not done and other.version() == 2


def outputs(n=400, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = D(2020, 1, 1) + dt.timedelta(days=rng.randrange(120))
        b = a + dt.timedelta(days=rng.choice([0, 1, 3, 40, 100])) if rng.random() < 0.6 else None
        out.append((f"k{i}", a, b, float(rng.randrange(1, 50)), float(rng.randrange(1, 9))))
    return out


def test_ranges_equal_the_interval_sums(spark, store):
    facts = spark.createDataFrame(outputs(), "key string, created date, spent date, value_usd double, value_btc double")
    spends = facts.where("spent is not null")
    ranges = [(D(2020, 1, 1), D(2020, 2, 10)), (D(2020, 2, 11), D(2020, 2, 11)), (D(2020, 2, 12), D(2020, 4, 2)), (D(2020, 3, 1), D(2020, 12, 31))]
    seen = [OO.advance(store, facts, spends, a, b) for a, b in ranges]
    assert OO.advance(store, facts, spends, D(2020, 2, 1), D(2020, 3, 1)) == {"months": [], "from": None}
    assert [s["from"] for s in seen] == [D(2020, 1, 1), D(2020, 2, 11), D(2020, 2, 12), D(2020, 4, 3)]
    assert rows(OO.realised_cap(store), "Date", "rc_usd", "rc_btc") == rows(U.realised_cap(facts), "Date", "rc_usd", "rc_btc")
    assert rows(store.read("open"), "key") == sorted((r[0],) for r in outputs() if r[2] is None)
    assert store.read("unknown").count() == 0


def test_a_day_reads_the_months_it_touches(spark, store):
    schema = "key string, created date, spent date, value_usd double, value_btc double"
    first = [(f"{m}", D(2020, m, 5), None, 10.0, 1.0) for m in range(1, 7)]
    OO.advance(store, spark.createDataFrame(first, schema), spark.createDataFrame([], schema), D(2020, 1, 1), D(2020, 6, 30))
    before = store.manifest()["open"]["parts"]
    day = [("new", D(2020, 7, 1), None, 5.0, 1.0), ("2", D(2020, 2, 5), D(2020, 7, 1), 0.0, 0.0), ("lost", D(2020, 3, 5), D(2020, 7, 1), 0.0, 0.0)]
    read = []
    store.read = lambda table, parts=None, version=None, real=store.read: (read.append((table, parts)), real(table, parts, version))[1]
    feed = spark.createDataFrame(day, schema)
    got = OO.advance(store, feed, feed.where("spent is not null"), D(2020, 7, 1), D(2020, 7, 1))
    assert got["months"] == ["202002", "202003", "202007"]
    assert [p for t, p in read if t == "open"] == [got["months"]]
    after = store.manifest()["open"]["parts"]
    assert {p for p in before if after.get(p) != before[p]} == {"202002", "202003"} and "202007" in after
    assert rows(store.read("days"), "Date", "rc_usd")[-1] == (D(2020, 7, 1), 65.0)
    assert rows(store.read("pending"), "Date", "u") == [(D(2020, 7, 2), -10.0)]
    assert rows(store.read("unknown"), "key") == [("lost",)]
