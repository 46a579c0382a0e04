"""Blocked running sums and moving means against plain loops."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from chainmetrics.operators import scans as S


def series(n=500, seed=1):
    rng = random.Random(seed)
    return [(dt.date(2020, 1, 1) + dt.timedelta(days=min(rng.randrange(40), 25)), i, float(rng.randrange(-50, 100))) for i in range(n)]


@pytest.mark.parametrize("blocks", [1, 5, 64])
def test_running_sums(spark, blocks):
    data = series()
    df = spark.createDataFrame(data, "day date, id long, v double").repartition(6)
    want, total = [], 0.0
    for d, i, v in sorted(data):
        total += v
        want.append((d, i, total))
    out = S.long_running_sums(df, ("day", "id"), {"s": "v"}, blocks)
    assert rows(out, "day", "id", "s") == want
    plan = out._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_groups_and_following_values(spark):
    data = [(g, x, (7 * x + (g or 0)) % 5) for g in (1, 2, None) for x in range(0, 60, 2 + (g or 0))]
    df = spark.createDataFrame(data, "g int, x long, v long").withColumn("b", S.block_of(F.col("x"), [9.0, 10.0, 31.0, 50.0]))
    got = {(r.g, r.x): (r.s, r.after) for r in S.running_sums(df, ("x",), {"s": F.col("v")}, "b", ("g",), {"after": "x"}).collect()}
    for g in (1, 2, None):
        mine = sorted((x, v) for h, x, v in data if h == g)
        total = 0
        for i, (x, v) in enumerate(mine):
            total += v
            assert got[g, x] == (total, mine[i + 1][0] if i + 1 < len(mine) else None)


@pytest.mark.parametrize("block_rows", [1, 30, 10_000])
def test_moving_means(spark, block_rows):
    data = sorted(series(200, 3))
    df = spark.createDataFrame(data, "day date, id long, v double").repartition(5)
    out = S.moving_means(df, ("day", "id"), "v", (1, 4, 25, 300), blocks=7, block_rows=block_rows)
    got = rows(out, "day", "id", "d1", "d4", "d25", "d300")
    assert len(got) == 200
    for n, r in enumerate(got):
        for w, v in zip((1, 4, 25, 300), r[2:]):
            want = sum(x[2] for x in data[n + 1 - w:n + 1]) / w if n + 1 >= w else None
            assert v == (want if want is None else pytest.approx(want))
    assert "SinglePartition" not in out._jdf.queryExecution().toString()


def test_empty_series(spark):
    df = spark.createDataFrame([], "day date, id long, v double")
    assert S.long_running_sums(df, ("day", "id"), {"s": "v"}).count() == 0
    assert S.moving_means(df, ("day", "id"), "v", (3,)).count() == 0
