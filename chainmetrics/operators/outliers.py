"""Outlier flags: contamination thresholds, centroid distances, k-means.

Cuts are exact and distributed by default: a sketch brackets the wanted ranks, a count and
the few rows inside the bracket give their exact values, and the threshold enters the flag
as a number. The detectors of the daily tables (one row per day) pass ``day_grain=True``
for a whole-frame window instead, which takes one pass over a plan of a few thousand rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainmetrics.operators import features as FE

# Share of rows flagged as outliers and the seed of the k-means fits.
OUTLIER_FRACTION = 0.05
KMEANS_SEED = 4103
#: Upper limit of the k-means steps; fits converge long before.
KMEANS_ITERATIONS = 300


def nlargest_count(n_rows, fraction: float = OUTLIER_FRACTION):
    """n = int(fraction * N): how many rows the cut keeps."""
    return F.floor(F.lit(fraction) * n_rows)


#: Accuracy of the bracketing sketch: ranks are off by at most one part in this many.
SKETCH_ACCURACY = 100_000


def order_statistics(df: DataFrame, score: str, ranks: list[int], n: int) -> list[float]:
    """Exact values at the 0-based ascending ``ranks`` of the ``n`` non-null scores.

    No row order over the whole frame is made: the rows between two sketched quantiles
    around each rank, a share of about 1e-4 of them, are the only ones sorted."""
    scores = df.select(F.col(score).cast("double").alias("_s")).where(F.col("_s").isNotNull())
    out = []
    for rank in ranks:
        margin = 2.0 / SKETCH_ACCURACY
        while True:
            lo_p, hi_p = max(0.0, (rank - 1) / n - margin), min(1.0, (rank + 2) / n + margin)
            lo, hi = scores.agg(F.percentile_approx("_s", [lo_p, hi_p], SKETCH_ACCURACY)).first()[0]
            below, inside = scores.agg(F.count_if(F.col("_s") < lo), F.count_if(F.col("_s").between(lo, hi))).first()
            if below <= rank < below + inside:
                break
            margin *= 8
        if lo == hi:
            out.append(lo)
        else:
            # Equal scores are one row with a count: ties can't make the sorted part large.
            few = scores.where(F.col("_s").between(lo, hi)).groupBy("_s").agg(F.count(F.lit(1)).alias("c"))
            upto = F.sum("c").over(Window.orderBy("_s")) + below
            out.append(few.withColumn("_upto", upto).where(F.col("_upto") > rank).agg(F.min("_s")).first()[0])
    return out


def _cut(df: DataFrame, score: str, fraction: float, method: str) -> tuple[int | None, float | None]:
    """(n, threshold) of the exact distributed cut."""
    total, n = df.agg(F.count(F.lit(1)), F.count(score)).first()
    if method == "nlargest":
        largest = int(np.floor(fraction * total))
        if largest == 0 or n == 0:
            return (largest if total else None), None
        return largest, order_statistics(df, score, [max(0, n - largest)], n)[0]
    if n == 0:
        return total, None
    place = (1.0 - fraction) * (n - 1)
    low, high = int(np.floor(place)), int(np.ceil(place))
    a, b = order_statistics(df, score, [low, high], n) if high > low else order_statistics(df, score, [low], n) * 2
    return total, a + (b - a) * (place - low)


def contamination_threshold(df: DataFrame, score: str, fraction: float = OUTLIER_FRACTION,
                            method: str = "nlargest", day_grain: bool = False) -> DataFrame:
    """One-row frame ``(n, threshold)`` for the outlier cut.

    * ``nlargest``: the smallest of the n = int(fraction*N) largest scores (null when n = 0);
    * ``percentile``: the (1-fraction) percentile, linear interpolation;
    * ``approx``: the same from ``percentile_approx``, without exact values.
    """
    if method == "approx":
        return df.agg(F.count(F.lit(1)).alias("n"),
                      F.percentile_approx(score, 1.0 - fraction, SKETCH_ACCURACY).alias("threshold"))
    if method not in ("nlargest", "percentile"):
        raise ValueError(method)
    if not day_grain:
        return df.sparkSession.createDataFrame([_cut(df, score, fraction, method)], "n LONG, threshold DOUBLE")
    if method == "nlargest":
        ranked = df.select(score, F.row_number().over(Window.orderBy(F.desc(score))).alias("_rn"),
                           F.count(F.lit(1)).over(Window.partitionBy()).alias("_n"))
        n = nlargest_count(F.col("_n"), fraction)
        return ranked.agg(F.max(n).cast("long").alias("n"),
                          F.min(F.when(F.col("_rn") <= n, F.col(score))).alias("threshold"))
    return df.agg(F.count(F.lit(1)).alias("n"), F.percentile(score, 1.0 - fraction).alias("threshold"))


def day_sketches(scores: DataFrame, score: str, day: str = "Date") -> DataFrame:
    """One row per day: rows, and a mergeable quantile sketch of the scores (D8). To be stored
    beside the scores; a new day adds its row."""
    return scores.where(F.col(score).isNotNull()).groupBy(day).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(score).cast("double")).alias("sketch"))


def range_cut(scores: DataFrame, sketches: DataFrame, score: str, start, end, fraction: float = OUTLIER_FRACTION,
              day: str = "Date") -> tuple[int, float | None]:
    """(n, threshold): the n = int(fraction N) largest scores of a day range, exactly.

    The range's sketches are merged and bracket the n-th largest; of the scores themselves only
    those from the bracket's lower end on are read (a filter that reaches the files), those
    above it are counted and those inside ranked by value."""
    within = F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    total, merged = sketches.where(within).agg(F.sum("n"), F.kll_merge_agg_double("sketch")).first()
    n = int(np.floor(fraction * (total or 0)))
    if n == 0:
        return n, None
    place = 1.0 - n / total
    margin = 0.02
    while True:
        ends = [max(0.0, place - margin), min(1.0, place + margin)]
        lo, hi = (sketches.sparkSession.createDataFrame([(bytearray(merged),)], "s binary")
                  .select(*[F.kll_sketch_get_quantile_double("s", F.lit(p)).alias(f"q{i}") for i, p in enumerate(ends)]).first())
        # The whole sketch range is no bracket of the extremes: open ends are taken from the scores.
        tail = scores.where(within & ((F.col(score) >= lo) if ends[0] > 0 else F.col(score).isNotNull())).select(F.col(score).cast("double").alias("_s"))
        inside = (F.col("_s") <= hi) if ends[1] < 1 else F.lit(True)
        above, among = tail.agg(F.count_if(~inside), F.count_if(inside)).first()
        if above < n <= above + among:
            few = tail.where(inside).groupBy("_s").agg(F.count(F.lit(1)).alias("c"))
            upto = F.sum("c").over(Window.orderBy(F.desc("_s"))) + above
            return n, few.withColumn("_upto", upto).where(F.col("_upto") >= n).agg(F.max("_s")).first()[0]
        margin *= 4


def flag_outliers(df: DataFrame, score: str, fraction: float = OUTLIER_FRACTION,
                  method: str = "nlargest", flag: str = "anomaly", strict: bool = False,
                  day_grain: bool = False) -> DataFrame:
    """Append ``flag`` = 1 where score >= threshold (``>`` when ``strict``), else 0.

    The threshold is computed first (see the module), so ``df`` is read a few times: hand
    over a stored frame where its plan is costly. ``day_grain`` uses windows in one pass.
    """
    base = df
    if method == "approx":
        thr = contamination_threshold(df, score, fraction, "approx").select("threshold").scalar()
    elif method not in ("nlargest", "percentile"):
        raise ValueError(method)
    elif not day_grain:
        thr = F.lit(_cut(df, score, fraction, method)[1]).cast("double")
    elif method == "nlargest":
        whole = Window.partitionBy()
        base = df.withColumns({
            "_rn": F.row_number().over(Window.orderBy(F.desc(score))),
            "_n": nlargest_count(F.count(F.lit(1)).over(whole), fraction),
        })
        thr = F.min(F.when(F.col("_rn") <= F.col("_n"), F.col(score))).over(whole)
    else:
        thr = F.percentile(score, 1.0 - fraction).over(Window.partitionBy())
    hit = (F.col(score) > thr) if strict else (F.col(score) >= thr)
    return base.withColumn(flag, F.coalesce(hit, F.lit(False)).cast("int")).drop("_rn", "_n")


def _dist(cols, centre):
    return F.sqrt(reduce(lambda a, b: a + b,
                         [F.pow(F.col(c) - F.lit(float(v)), 2) for c, v in zip(cols, centre)]))


def assign_centres(df: DataFrame, cols, centres, cluster: str = "cluster",
                   distance: str = "distance") -> DataFrame:
    """Nearest centre (ties -> lower index) and the distance to it, as expressions.

    Centres are a small literal parameter (k x d numbers), not a joined table.
    """
    dists = [_dist(cols, c) for c in centres]
    best = F.least(*dists) if len(dists) > 1 else dists[0]
    idx = F.lit(None).cast("int")
    for i in reversed(range(len(dists))):
        idx = F.when(dists[i] == best, F.lit(i)).otherwise(idx)
    return df.withColumn(distance, best).withColumn(cluster, idx)


def centroid_distance_outliers(df: DataFrame, cols, centres, fraction: float = OUTLIER_FRACTION,
                               flag: str = "anomaly", day_grain: bool = False) -> DataFrame:
    """Distance of each row to its nearest centre; flag the int(fraction*N) farthest."""
    return flag_outliers(assign_centres(df, cols, centres), "distance", fraction, "nlargest", flag, day_grain=day_grain)


def kmeans_fit(df: DataFrame, cols, k: int, seed: int = KMEANS_SEED, max_iter: int = KMEANS_ITERATIONS):
    """MLlib k-means (scalable k-means++ initialisation) on ``cols``, run to convergence:
    it ends when no centre moves by more than the tolerance."""
    data = FE.assemble(df, cols, "_features")
    return KMeans(k=k, seed=seed, maxIter=max_iter, tol=1e-4, featuresCol="_features",
                  predictionCol="cluster").fit(data)


def kmeans_cluster(df: DataFrame, cols, k: int, seed: int = KMEANS_SEED) -> DataFrame:
    """Cluster label per row (H6)."""
    model = kmeans_fit(df, cols, k, seed)
    return model.transform(FE.assemble(df, cols, "_features")).drop("_features")


def kmeans_elbow(df: DataFrame, cols, ks=range(1, 20), seed: int = KMEANS_SEED,
                 parallel: int = 4) -> DataFrame:
    """(k, score = -SSE) for each k (H5). k = 1 is the SSE around the mean (one aggregate).

    The fits are independent Spark jobs; up to ``parallel`` of them are
    submitted at once from driver threads so the cluster is not idle between
    the short iterations of one fit. ``df`` is read by every fit: hand over a stored frame.
    """
    from concurrent.futures import ThreadPoolExecutor

    df = df.select(*cols)

    def sse(k):
        if k == 1:
            return df.agg(reduce(lambda a, b: a + b,
                                 [F.coalesce(F.var_pop(c) * F.count(F.lit(1)), F.lit(0.0)) for c in cols])
                          ).first()[0]
        return kmeans_fit(df, cols, k, seed).summary.trainingCost

    ks = [int(k) for k in ks]
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        costs = list(pool.map(sse, ks))
    rows = [(k, -float(c)) for k, c in zip(ks, costs)]
    return df.sparkSession.createDataFrame(rows, "k INT, score DOUBLE")


#: Places to which the difference curve is rounded, so that equal heights are equal.
KNEE_PLACES = 9


def knees(curve: DataFrame, x: str = "x", y: str = "y", sensitivity: float = 1.0, by=()) -> DataFrame:
    """(by, x, height) of all knees of concave increasing curves (Satopaa et al. 2011), one curve per ``by`` (H5).

    Both axes are scaled to 0 .. 1; the difference curve is y - x. A local maximum of it is a knee if
    the curve falls, before the next maximum, more than ``sensitivity`` mean steps of x
    below it. ``x`` is unique; curves of fewer than three points or without range have none.
    A curve is one window: day-grain tables and score lists."""
    whole, order = Window.partitionBy(*by), Window.partitionBy(*by).orderBy(x)

    def scaled(c):
        c = F.col(c).cast("double")
        return (c - F.min(c).over(whole)) / F.nullif(F.max(c).over(whole) - F.min(c).over(whole), F.lit(0.0))

    d = curve.select(*by, F.col(x).alias("x"), F.round(scaled(y) - scaled(x), KNEE_PLACES).alias("height"),
                     F.try_divide(F.lit(float(sensitivity)), F.count(F.lit(1)).over(whole) - 1).alias("drop"))
    at = Window.partitionBy(*by).orderBy("x")
    top = F.coalesce((F.col("height") > F.lag("height").over(at)) & (F.col("height") >= F.lead("height").over(at)), F.lit(False))
    d = d.withColumn("top", top).withColumn("part", F.sum(F.col("top").cast("int")).over(at))
    # A part begins with its maximum.
    part = d.where("part > 0").groupBy(*by, "part").agg(F.min("x").alias("x"), F.max_by("height", F.col("top").cast("int")).alias("height"),
                                                        F.min("height").alias("least"), F.min("drop").alias("drop"))
    return part.where(F.col("least") < F.col("height") - F.col("drop")).select(*by, "x", "height")


def knee(points, sensitivity: float = 1.0) -> int | None:
    """The first knee of a short list of (x, y) pairs, by the same rule as ``knees``."""
    pts = sorted(points)
    if len(pts) < 3:
        return None
    x, y = (np.array(v, dtype=float) for v in zip(*pts))
    if x.max() == x.min() or y.max() == y.min():
        return None
    d = np.round((y - y.min()) / (y.max() - y.min()) - (x - x.min()) / (x.max() - x.min()), KNEE_PLACES)
    tops = [i for i in range(1, len(d) - 1) if d[i] > d[i - 1] and d[i] >= d[i + 1]]
    for i, following in zip(tops, [*tops[1:], len(d)]):
        if d[i:following].min() < d[i] - sensitivity / (len(d) - 1):
            return int(x[i])
    return None


def kmeans_outliers(df: DataFrame, cols, k: int = 4, fraction: float = OUTLIER_FRACTION,
                    seed: int = KMEANS_SEED, keep=("Date",), day_grain: bool = False) -> DataFrame:
    """Min-max scale -> 2-component PCA -> k-means -> distance to the row's own
    centre -> flag the farthest int(fraction*N) rows (H7).

    Output: keep columns, pc1, pc2, the raw features, anomaly, cluster.
    """
    scaled = FE.minmax_scale(df.select(*keep, *cols), cols, suffix="_s")
    proj = FE.pca_project(scaled, [c + "_s" for c in cols], 2)
    model = kmeans_fit(proj, ["pc1", "pc2"], k, seed)
    centres = [list(c) for c in model.clusterCenters()]
    flagged = centroid_distance_outliers(proj, ["pc1", "pc2"], centres, fraction, day_grain=day_grain)
    return flagged.select(*keep, "pc1", "pc2", *cols, "anomaly", "cluster")
