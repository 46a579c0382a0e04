"""Stream pairing on the state store: any order, restarts, partners that never come."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from chainmetrics.session import scratch_path
from chainmetrics.streaming import pairing as P

LINE = "k long, v double, landed timestamp"
ORDER = "id long, day date, landed timestamp"


def hour(n):
    return dt.datetime(2020, 1, 1) + dt.timedelta(hours=n)


@pytest.fixture(autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Feeds:
    def __init__(self, spark):
        self.spark = spark
        self.lines, self.orders, self.path, self.ckpt = (scratch_path(spark, x) for x in ("lines", "orders", "paired", "ckpt"))
        self.put([], [], 0)

    def put(self, lines, orders, n):
        """One more file of each feed, landed at hour n."""
        for path, schema, data in ((self.lines, LINE, lines), (self.orders, ORDER, orders)):
            self.spark.createDataFrame([(*r, hour(n)) for r in data], schema).coalesce(1).write.mode("append").parquet(path)

    def run(self, clock=True, wait="10 HOURS", **options):
        read = lambda schema, path: self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        lines, orders = read(LINE, self.lines), read(ORDER, self.orders)
        if not clock:
            lines, orders = lines.drop("landed"), orders.drop("landed")
        return P.run_pairing(lines, orders, "k", "id", self.path, self.ckpt, wait, clock=F.col("landed") if clock else None, **options)


def test_any_order_and_restarts_equal_the_batch_join(spark):
    rng = random.Random(1)
    lines = [(rng.randrange(30), float(i)) for i in range(80)] + [(None, -1.0), (None, -1.0), (3, 5.0), (3, 5.0)]
    orders = [(k, dt.date(2020, 1, 1)) for k in range(40) if k % 7] + [(4, dt.date(2021, 1, 1)), (None, None)]
    rng.shuffle(lines)
    rng.shuffle(orders)
    feeds, n = Feeds(spark), 1
    for part in range(4):
        feeds.put(lines[part::4], orders[part::4], n)
        n += 1
        if part != 1:
            feeds.run()  # each run is a restart from the checkpoint
    feeds.put([], [(None, None)], 100)
    feeds.run()
    partner = {}
    for k, d in orders:
        partner.setdefault(k, []).append(d)
    want = sorted((k, v, k, d) for k, v in lines if k is not None for d in partner.get(k, []))
    assert rows(P.read_pairs(spark, feeds.path, late=False), "k", "v", "id", "day") == want
    late = sorted(((k, v) for k, v in lines if k is None or k not in partner), key=str)
    assert sorted(rows(P.read_pairs(spark, feeds.path, late=True).where("k is not null"), "k", "v")) == [r for r in sorted(late, key=lambda r: (r[0] or 0, r[1])) if r[0] is not None]
    assert P.read_pairs(spark, feeds.path, late=True).where("k is null").count() == 2


def test_state_falls_after_expiry(spark):
    feeds = Feeds(spark)
    feeds.put([(k, 1.0) for k in range(100)], [(k, None) for k in range(50)], 1)
    grown = feeds.run()[-1]["state_rows"]
    assert grown == 150
    assert P.read_pairs(spark, feeds.path, late=True).count() == 0
    feeds.put([], [(None, None)], 50)
    assert feeds.run()[-1]["state_rows"] <= 1
    assert P.read_pairs(spark, feeds.path, late=True).count() == 50


def test_partner_is_remembered_for_its_time(spark):
    """A partner first, its row later; beyond ``keep`` the row is late."""
    feeds = Feeds(spark)
    feeds.put([], [(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 1))], 1)
    feeds.run(keep="3 HOURS")
    feeds.put([(1, 1.0)], [], 3)
    feeds.run(keep="3 HOURS")
    feeds.put([(2, 2.0)], [], 20)
    feeds.run(keep="3 HOURS")
    feeds.put([], [(None, None)], 50)
    feeds.run(keep="3 HOURS")
    assert rows(P.read_pairs(spark, feeds.path), "k", "late") == [(1, False), (2, True)]


def test_clock_of_the_batches(spark):
    """Without a clock of its own a feed's days and order don't matter."""
    feeds = Feeds(spark)
    feeds.put([(1, 1.0)], [], 900)
    feeds.run(clock=False, wait="1 DAY")
    feeds.put([(2, 2.0)], [(1, None)], 1)
    seen = feeds.run(clock=False, wait="1 DAY")
    assert rows(P.read_pairs(spark, feeds.path), "k", "late") == [(1, False)]
    assert seen[-1]["state_rows"] == 3


def test_a_clock_that_runs_backwards_is_an_error(spark):
    feeds = Feeds(spark)
    feeds.put([(1, 1.0)], [], 30)
    feeds.run()
    feeds.put([(2, 1.0)], [], 2)
    with pytest.raises(RuntimeError, match="backwards"):
        feeds.run()


def test_shared_columns_are_refused(spark):
    with pytest.raises(ValueError):
        P.pair_streams(spark.range(1), spark.range(1), "id", "id", "1 DAY")
