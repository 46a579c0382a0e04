"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

1. Sampling: one hash per row keeps the rows any tree could use (rate
   trees x p, p ~ (psi + margin) / N); among those, a row joins tree t's sample
   when a hash of (row id, t, seed) is below p / (trees x p). No global window,
   no shuffle of the full data: only about trees x (psi + margin) rows are
   emitted in total.
2. Fitting: ``groupBy(tree).applyInPandas`` keeps the psi smallest hashes of its
   tree (a bounded group) and grows one isolation tree; all trees in parallel.
3. Scoring: the trees (<= trees x (2 psi - 1) nodes, a size fixed by the
   parameters, not by the data) are broadcast and a pandas UDF walks all trees
   for an Arrow batch of rows at once. Score = 2^(-E[h(x)] / c(psi)).
4. Flag: score above the (1 - contamination) percentile.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from chainmetrics.session import ship_package
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from chainmetrics.operators import outliers as O

# Fixed values of the reference configuration: 100 trees, 256-row samples, seed 111.
TREES = 100
SAMPLE = 256
SEED = 111
EULER_GAMMA = 0.5772156649015329

NODE_SCHEMA = "tree INT, node INT, feature INT, split DOUBLE, left INT, right INT, size LONG, depth INT"


def average_path_length(n):
    """c(n): average path length of an unsuccessful search in a binary search tree of n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow(cols, sample: int, seed: int):
    limit = max(1, int(math.ceil(math.log2(max(sample, 2)))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["_u", "_id"]).head(sample)
        x = pdf[list(cols)].to_numpy(dtype=float)
        rng = np.random.RandomState(seed + tree)
        nodes = []  # (node, feature, split, left, right, size, depth)
        stack = [(0, np.arange(len(x)), 0)]
        nodes.append(None)
        while stack:
            nid, idx, depth = stack.pop()
            sub = x[idx]
            if depth >= limit or len(idx) <= 1:
                nodes[nid] = (nid, -1, 0.0, -1, -1, len(idx), depth)
                continue
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            free = np.flatnonzero(hi > lo)
            if free.size == 0:
                nodes[nid] = (nid, -1, 0.0, -1, -1, len(idx), depth)
                continue
            f = int(free[rng.randint(free.size)])
            s = float(rng.uniform(lo[f], hi[f]))
            go_left = sub[:, f] < s
            left, right = len(nodes), len(nodes) + 1
            nodes += [None, None]
            nodes[nid] = (nid, f, s, left, right, len(idx), depth)
            stack.append((right, idx[~go_left], depth + 1))
            stack.append((left, idx[go_left], depth + 1))
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size", "depth"])
        out.insert(0, "tree", tree)
        return out

    return build


def fit_isolation_forest(df: DataFrame, cols, trees: int = TREES, sample: int = SAMPLE,
                         seed: int = SEED, id_col: str | None = None):
    """Grow the forest; returns (node arrays per tree, psi)."""
    ship_package(df.sparkSession)
    cols = list(cols)
    rid = F.col(id_col) if id_col else F.xxhash64(*[F.col(c) for c in cols])
    base = df.select(rid.cast("long").alias("_id"), *[F.col(c).cast("double") for c in cols])
    n = base.count()
    psi = max(1, min(sample, n))
    margin = psi + 8.0 * math.sqrt(psi) + 16.0
    p = min(1.0, margin / max(n, 1))
    # One hash per row first: keep rows that any tree could sample (rate
    # p0 = trees x p), then draw each tree's rows among those few only.
    p0 = min(1.0, trees * p)

    def unit(*cols):
        return (F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1_000_000_007)).cast("double")
                / F.lit(1_000_000_007.0))

    pool = base.where(unit(F.col("_id"), F.lit(-1)) < F.lit(p0))
    picked = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)),
                      lambda t: unit(F.col("_id"), t) < F.lit(p / p0))
    samples = (pool.select("*", F.explode(picked).alias("tree"))
               .withColumn("_u", unit(F.col("_id"), F.col("tree"))))
    nodes = samples.groupBy("tree").applyInPandas(_grow(cols, psi, seed), NODE_SCHEMA)
    # Bounded by trees x (2 psi - 1) rows: parameters, not data size.
    pdf = nodes.toPandas().sort_values(["tree", "node"])
    forest = []
    for _, g in pdf.groupby("tree"):
        forest.append({k: g[k].to_numpy() for k in ("feature", "split", "left", "right", "size", "depth")})
    return forest, psi


def _score_fn(bforest, psi: int):
    cpsi = float(average_path_length([psi])[0]) or 1.0

    def score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        forest = bforest.value
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in forest:
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                feat = t["feature"][node]
                inner = feat >= 0
                if not inner.any():
                    break
                f = np.where(inner, feat, 0)
                goes_left = x[rows, f] < t["split"][node]
                nxt = np.where(goes_left, t["left"][node], t["right"][node])
                node = np.where(inner, nxt, node)
            total += t["depth"][node] + average_path_length(t["size"][node])
        mean_h = total / max(len(forest), 1)
        return pd.Series(np.power(2.0, -mean_h / cpsi))

    return score


def isolation_forest(df: DataFrame, cols, fraction: float = O.OUTLIER_FRACTION, trees: int = TREES,
                     sample: int = SAMPLE, seed: int = SEED, id_col: str | None = None,
                     score: str = "score", flag: str = "anomaly", threshold: str = "percentile",
                     day_grain: bool = False) -> DataFrame:
    """Append the isolation score and a 0/1 outlier flag (H8).

    ``id_col`` tells rows with equal features apart in the samples. The cut is exact and
    distributed; ``day_grain`` takes it with a window over a small daily table.
    """
    forest, psi = fit_isolation_forest(df, cols, trees, sample, seed, id_col)
    bforest = df.sparkSession.sparkContext.broadcast(forest)
    udf = F.pandas_udf(_score_fn(bforest, psi), DoubleType())
    scored = df.withColumn(score, udf(*[F.col(c).cast("double") for c in cols]))
    return O.flag_outliers(scored, score, fraction, threshold, flag, strict=True, day_grain=day_grain)
