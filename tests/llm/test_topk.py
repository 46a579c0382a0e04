"""Exact search against a sort of all scores."""

import math
import random

from llm_helpers import tables  # noqa: F401
from pyspark.sql import functions as F

from chainmetrics.llm import queries, topk


def brute(rows, k):
    ok = {i: [math.floor(1024 * float(x)) for x in v] for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, v in ok.items():
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in ok.items() if c != q)
            out |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])}
    return out


def vectors(seed, n, dims=40):
    r = random.Random(seed)
    base = [[r.randint(-512, 512) / 512 for _ in range(dims)] for _ in range(5)]
    rows = [(i, [x if r.random() < 0.7 else r.randint(-512, 512) / 512 for x in r.choice(base)]) for i in range(n)]
    rows += [(n + i, list(rows[0][1])) for i in range(30)]  # ties
    return rows + [(n + 100, None), (n + 101, [None] + [0.5] * (dims - 1)), (n + 102, [float("nan")] * dims), (n + 103, [float("inf")] * dims)]


def test_query(spark, tables):
    rows = vectors(1, 460)
    folder = tables(embeddings=[(i, v, 0) for i, v in rows])
    got = queries.QUERIES["op6_topk"](spark, folder)
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()} == brute(rows, 10)


def test_blocks_large_values_and_edges(spark):
    rows = vectors(2, 350, 17)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string").repartition(5)
    got = topk.top_k(df, F.col("vec_id") % 100 == 0, k=3, query_block=2)
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()} == brute(rows, 3)
    big = [(0, [2.0**30, 1.0]), (1, [2.0**12, 0.5]), (2, [2.0**12, 0.25]), (3, [-1.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>"), F.col("vec_id") == 0)
    assert [(r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(v, s) for _, _, v, s in sorted(brute(big, 10))]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    alone = topk.top_k(df.where("vec_id = 0"), F.col("vec_id") % 100 == 0)
    assert alone.count() == 0


def test_invalid_rows_of_a_query_id_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (0, [None, 1.0]), (0, [float("inf"), 0.0]), (0, [float("-inf"), 0.0]), (0, None), (1, [1.0, 1.0]), (2, [0.5, float("nan")]), (3, [2.0, 2.0])]
    for parts, data in ((1, rows), (3, rows[::-1])):
        df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(parts)
        got = sorted((r.rank, r.vec_id) for r in topk.top_k(df, F.col("vec_id") == 0).collect())
        assert got == [(1, 3), (2, 1)]
