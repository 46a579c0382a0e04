"""Isolation forest whose draws are md5 hashes, so that any engine can state it.

Samples, features and split points follow from the md5 of (tree, row) or (tree, node):

1. Sampling: a row joins tree t's sample when its draw for t is below ``sample / N``: no
   window, no shuffle of rows; about trees x sample rows go on.
2. Growing, level by level on Spark: one aggregation per level (rows, least and greatest
   value of each feature by tree and node, map-side combined) gives every node its
   feature, drawn among those that still vary, and its split, drawn between the two
   values; the sample rows move to the children 2 n and 2 n + 1. A node of one row, of
   equal rows or at depth ceil(log2(sample)) is a leaf.
3. Scoring: trees x 2^(depth + 1) nodes, a size fixed by the parameters, are one array in heap order
   (a scalar subquery); rows walk it with higher-order functions, row-local, no Python.
   Score = 2^(-mean path / c(sample)), a path being its leaf's depth + c(rows of the leaf).

Defined results: rows with a null or NaN feature take no part in the trees and get a null score;
a null id draws like the empty text; repeated rows draw alike; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainmetrics.operators.isoforest import EULER_GAMMA, SAMPLE, TREES
from chainmetrics.session import materialize


def draw(*parts: Column) -> Column:
    """Number in (0, 1) from the md5 of the parts as text, joined by colons."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def path_excess(n: Column) -> Column:
    """c(n): average path length of an unsuccessful search among n points."""
    n = n.cast("double")
    return (F.when(n > 2, 2.0 * (F.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n)
            .when(n == 2, 1.0).otherwise(0.0))


def depth_limit(sample: int) -> int:
    return max(1, math.ceil(math.log2(max(sample, 2))))


def draw_samples(rows: DataFrame, trees: int, sample: int) -> DataFrame:
    """(tree, x, node 1) of the rows (id, x) of each tree's sample."""
    n = float(rows.count())
    if not n:
        return rows.select(F.lit(0).alias("tree"), "x", F.lit(1).cast("long").alias("node"))
    mine = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(F.lit("row"), t, F.col("id")) < sample / n)
    return rows.select(F.explode(mine).alias("tree"), "x", F.lit(1).cast("long").alias("node"))


def split_nodes(members: DataFrame, features: int, last: bool) -> DataFrame:
    """Nodes of one level: tree, node, size, feature (0 based; -1 for a leaf) and split."""
    values = [f(F.col("x")[i]).alias(f"{name}{i}") for i in range(features) for name, f in (("lo", F.min), ("hi", F.max))]
    stats = members.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("size"), *values)
    lo, hi = (F.array(*[F.col(f"{name}{i}") for i in range(features)]) for name in ("lo", "hi"))
    free = F.filter(F.array(*[F.lit(i) for i in range(features)]), lambda i: F.get(F.col("hi"), i) > F.get(F.col("lo"), i))
    picked = F.floor(draw(F.lit("feature"), F.col("tree"), F.col("node")) * F.size("free")).cast("int")
    leaf = F.lit(last) | (F.size("free") == 0)
    return (stats.select("tree", "node", "size", lo.alias("lo"), hi.alias("hi")).withColumn("free", free)
            .withColumn("feature", F.when(leaf, F.lit(-1)).otherwise(F.get("free", picked)))
            .withColumn("split", F.when(F.col("feature") >= 0, F.get("lo", F.col("feature")) + draw(F.lit("split"), F.col("tree"), F.col("node"))
                                        * (F.get("hi", F.col("feature")) - F.get("lo", F.col("feature")))))
            .select("tree", "node", "size", "feature", "split"))


def grow(df: DataFrame, cols, id_col: str, trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """Node table of the forest: tree, node, size, feature, split."""
    values = [F.col(c).cast("double") for c in cols]
    whole = [c.isNotNull() & ~F.isnan(c) for c in values]
    rows = df.select(F.col(id_col).alias("id"), F.array(*values).alias("x"), F.array(*whole).alias("ok")).where(F.forall("ok", lambda c: c)).drop("ok")
    members, levels = materialize(draw_samples(rows, trees, sample)), []
    for depth in range(depth_limit(sample) + 1):
        nodes = materialize(split_nodes(members, len(cols), depth == depth_limit(sample)))
        levels.append(nodes)
        # At most trees x 2^depth nodes: the broadcast is bounded by the parameters.
        inner = F.broadcast(nodes.where("feature >= 0").drop("size"))
        members = (members.join(inner, ["tree", "node"])
                   .select("tree", "x", (F.col("node") * 2 + (F.get("x", F.col("feature")) >= F.col("split")).cast("long")).alias("node")))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return materialize(out)


def score_rows(df: DataFrame, nodes: DataFrame, cols, trees: int = TREES, sample: int = SAMPLE, score: str = "score") -> DataFrame:
    """Append the isolation score of every row."""
    width = 2 ** (depth_limit(sample) + 1)
    places = df.sparkSession.range(trees * width).withColumnRenamed("id", "place")
    known = nodes.select((F.col("tree") * width + F.col("node")).alias("place"), "feature", "split", path_excess(F.col("size")).alias("excess"))
    # Places without a node are leaves of no rows.
    heap = (places.join(known, "place", "left")
            .agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("feature", F.lit(-1)).alias("feature"), F.coalesce("split", F.lit(0.0)).alias("split"),
                                                      F.coalesce("excess", F.lit(0.0)).alias("excess"))))).scalar())
    x = F.array(*[F.col(c).cast("double") for c in cols])
    forest, value = F.col("_forest"), F.col("_x")

    def walk(t):
        start = F.struct(F.lit(1).alias("node"), F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit(0.0).alias("excess"))

        def step(state, _):
            here = F.get(forest, t * width + state["node"])
            ends = state["done"] | (here["feature"] < 0)
            right = (F.get(value, here["feature"]) >= here["split"]).cast("int")
            return F.struct(F.when(ends, state["node"]).otherwise(state["node"] * 2 + right).alias("node"),
                            F.when(ends, state["depth"]).otherwise(state["depth"] + 1).alias("depth"), ends.alias("done"),
                            F.when(state["done"], state["excess"]).when(ends, here["excess"]).otherwise(0.0).alias("excess"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(depth_limit(sample))), start, step, lambda s: s["depth"] + s["excess"])

    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), walk), F.lit(0.0), lambda a, b: a + b)
    known = F.forall("_x", lambda c: c.isNotNull() & ~F.isnan(c))
    norm = path_excess(F.lit(sample))
    return (df.withColumn("_x", x).withColumn("_forest", heap)
            .withColumn(score, F.when(known, F.pow(F.lit(2.0), -(total / trees) / norm)))
            .drop("_x", "_forest"))
