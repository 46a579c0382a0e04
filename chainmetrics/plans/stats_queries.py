"""Registered queries: scaling, thresholds, PCA and outlier flags on the daily features."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainmetrics.operators import features as FE
from chainmetrics.operators import outliers as O
from chainmetrics.operators import serving as S
from chainmetrics.plans.registry import VIEWS, register, with_views
from chainmetrics.plans.rounding import RATIO, round_all, sql_rnd
from chainmetrics.plans.serving_queries import tables
from chainmetrics.session import materialize, scratch_path
from chainmetrics.sources import adapters as A

# The five daily features of the outlier detectors and the two of k-means.
FEATURES = ("tv_usd", "tx_count", "cdd", "circulating_supply", "price")
KM_FEATURES = ("tv_usd", "tx_count")
# Centres in the min-max scaled (tv_usd, tx_count) plane for the fixed-centre check.
CENTRES = ((0.1, 0.1), (0.3, 0.3), (0.5, 0.5), (0.8, 0.8))

VIEWS.update({
    "features": ("SELECT Date, " + ", ".join(FEATURES) + " FROM basic", ("basic",)),
    "mm": ("SELECT Date, tv_usd, tx_count, "
           "(tv_usd - min(tv_usd) OVER ()) / CASE WHEN max(tv_usd) OVER () = min(tv_usd) OVER () THEN 1 "
           "ELSE max(tv_usd) OVER () - min(tv_usd) OVER () END AS tv_usd_s, "
           "(tx_count - min(tx_count) OVER ()) / CASE WHEN max(tx_count) OVER () = min(tx_count) OVER () "
           "THEN 1 ELSE max(tx_count) OVER () - min(tx_count) OVER () END AS tx_count_s FROM features",
           ("features",)),
    "cd": ("SELECT *, least(" + ", ".join(f"d{i}" for i in range(len(CENTRES))) + ") AS distance FROM ("
           "SELECT *, " + ", ".join(
               f"sqrt(power(tv_usd_s - {cx}, 2) + power(tx_count_s - {cy}, 2)) AS d{i}"
               for i, (cx, cy) in enumerate(CENTRES)) + " FROM mm)", ("mm",)),
    "cd_flag": ("SELECT *, CASE " + " ".join(f"WHEN d{i} = distance THEN {i}" for i in range(len(CENTRES)))
                + " END AS cluster, CAST(coalesce(distance >= (SELECT min(distance) FROM ("
                "SELECT distance, row_number() OVER (ORDER BY distance DESC) AS rn, count(*) OVER () AS n "
                "FROM cd) WHERE rn <= floor(0.05 * n)), false) AS INTEGER) AS anomaly FROM cd", ("cd",)),
})


def daily_features(t):
    """The five daily features, materialised once (a few thousand rows) so the
    scaler statistics, thresholds and model fits read them, not the facts."""
    basic, _ = tables(t)
    return materialize(basic.select("Date", *FEATURES))


def _scaled(t):
    return FE.minmax_scale(daily_features(t).select("Date", *KM_FEATURES), KM_FEATURES, "_s")


def _z_sql(c: str) -> str:
    return (f"(({c}) - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
            f"ELSE stddev_pop({c}) OVER () END")


@register("standard_scale", with_views(
    "SELECT Date, " + ", ".join(f"{sql_rnd(_z_sql(c), RATIO)} AS {c}" for c in FEATURES) + " FROM features",
    "features"))
def q_standard_scale(t):
    z = FE.standard_scale(daily_features(t), FEATURES)
    return round_all(z, {c: RATIO for c in FEATURES})


@register("minmax_scale", with_views(
    f"SELECT Date, {sql_rnd('tv_usd_s', RATIO)} AS tv_usd_s, {sql_rnd('tx_count_s', RATIO)} AS tx_count_s "
    "FROM mm", "mm"))
def q_minmax_scale(t):
    return round_all(_scaled(t).select("Date", "tv_usd_s", "tx_count_s"), {"tv_usd_s": RATIO, "tx_count_s": RATIO})


@register("contamination_threshold", with_views(f"""
    SELECT CAST(max(floor(0.05 * n)) AS BIGINT) AS n,
           {sql_rnd('min(CASE WHEN rn <= floor(0.05 * n) THEN tv_usd END)', RATIO)} AS threshold
    FROM (SELECT tv_usd, row_number() OVER (ORDER BY tv_usd DESC) AS rn, count(*) OVER () AS n FROM features)""",
    "features"))
def q_contamination_threshold(t):
    """Smallest of the int(0.05 N) largest daily USD volumes (D8 a)."""
    return round_all(O.contamination_threshold(daily_features(t), "tv_usd"), {"threshold": RATIO})


@register("contamination_percentile", with_views(
    f"SELECT count(*) AS n, {sql_rnd('quantile_cont(tv_usd, 0.95)', RATIO)} AS threshold FROM features",
    "features"))
def q_contamination_percentile(t):
    """0.95 percentile of daily USD volume, linear interpolation (D8 b)."""
    return round_all(O.contamination_threshold(daily_features(t), "tv_usd", method="percentile"),
                     {"threshold": RATIO})


@register("centroid_distance_outliers", with_views(
    f"SELECT Date, {sql_rnd('distance', RATIO)} AS distance, cluster, anomaly FROM cd_flag", "cd_flag"))
def q_centroid_distance(t):
    """Distance to the nearest of four given centres; flag the farthest 5 %."""
    out = O.centroid_distance_outliers(_scaled(t), ["tv_usd_s", "tx_count_s"], CENTRES, day_grain=True)
    return round_all(out.select("Date", "distance", "cluster", "anomaly"), {"distance": RATIO})


@register("outlier_series", with_views(
    "SELECT Date, 'tv_usd' AS feature, " + sql_rnd("tv_usd", RATIO) + " AS value, CASE WHEN anomaly = 1 THEN "
    + sql_rnd("tv_usd", RATIO) + " END AS outlier_value FROM cd_flag UNION ALL "
    "SELECT Date, 'tx_count', CAST(tx_count AS DOUBLE), CASE WHEN anomaly = 1 THEN CAST(tx_count AS DOUBLE) END "
    "FROM cd_flag", "cd_flag"))
def q_outlier_series(t):
    """Per feature: the whole line plus the flagged points (I2), flags from the centre distances."""
    out = O.centroid_distance_outliers(_scaled(t), ["tv_usd_s", "tx_count_s"], CENTRES, day_grain=True)
    out = round_all(out, {"tv_usd": RATIO})
    return S.outlier_series(out, KM_FEATURES)


def _pca_sql() -> str:
    return with_views("""
    SELECT Date, """ + sql_rnd("s1 * ((tv_usd_s - mx) * v1x + (tx_count_s - my) * v1y)", RATIO) + """ AS pc1, """
                      + sql_rnd("s2 * (-(tv_usd_s - mx) * v1y + (tx_count_s - my) * v1x)", RATIO) + """ AS pc2
    FROM mm, (
      SELECT *, CASE WHEN abs(v1x) >= abs(v1y) THEN sign(v1x) ELSE sign(v1y) END AS s1,
                CASE WHEN abs(v1y) >= abs(v1x) THEN sign(-v1y) ELSE sign(v1x) END AS s2
      FROM (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS v1x,
                      (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS v1y
            FROM (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l1
                  FROM (SELECT avg(tv_usd_s) AS mx, avg(tx_count_s) AS my, var_pop(tv_usd_s) AS a,
                               var_pop(tx_count_s) AS c, covar_pop(tv_usd_s, tx_count_s) AS b FROM mm))))""",
                      "mm")


@register("pca_project", _pca_sql())
def q_pca_project(t):
    """Two principal components of the scaled (tv_usd, tx_count) plane (H3)."""
    proj = FE.pca_project(_scaled(t), ["tv_usd_s", "tx_count_s"], 2)
    return round_all(proj.select("Date", "pc1", "pc2"), {"pc1": RATIO, "pc2": RATIO})


# -- model-based, rows-only checks -------------------------------------------------

PCA_REPORT_SQL = with_views("""
    SELECT 'Dimension 1' AS dimension, round(l1 / (a + c), 4) AS explained_variance,
           round(s1 * v1x, 4) AS tv_usd_s, round(s1 * v1y, 4) AS tx_count_s FROM axes
    UNION ALL SELECT 'Dimension 2', round((a + c - l1) / (a + c), 4), round(-s2 * v1y, 4), round(s2 * v1x, 4) FROM axes""",
    "axes", extra={"axes": ("""
      SELECT *, CASE WHEN abs(v1x) >= abs(v1y) THEN sign(v1x) ELSE sign(v1y) END AS s1,
                CASE WHEN abs(v1y) >= abs(v1x) THEN sign(-v1y) ELSE sign(v1x) END AS s2
      FROM (SELECT *, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS v1x, (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS v1y
            FROM (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l1
                  FROM (SELECT var_pop(tv_usd_s) AS a, var_pop(tx_count_s) AS c, covar_pop(tv_usd_s, tx_count_s) AS b FROM mm)))""", ("mm",))})


@register("pca_report", PCA_REPORT_SQL)
def q_pca_report(t):
    """Explained variance and loadings of both components (H4); oracle in closed form."""
    return FE.pca_report(_scaled(t), ["tv_usd_s", "tx_count_s"], 2)


@register("kmeans_elbow")
def q_kmeans_elbow(t):
    """Score of every k from 1 to 19 and the knee of the curve (H5)."""
    proj = materialize(FE.pca_project(_scaled(t), ["tv_usd_s", "tx_count_s"], 2))
    points = O.kmeans_elbow(proj, ["pc1", "pc2"])
    # Nineteen points: the knee is found on the driver.
    return points.withColumn("knee", F.lit(O.knee([(r.k, r.score) for r in points.collect()])).cast("int"))


def _clusters(t):
    """Labels for k = 3, 4 and 5 (the reference fits all three and keeps 4)."""
    proj = materialize(FE.pca_project(_scaled(t), ["tv_usd_s", "tx_count_s"], 2))
    fits = [O.kmeans_cluster(proj, ["pc1", "pc2"], k).select(F.lit(k).alias("k"), "Date", "pc1", "pc2", "cluster") for k in (3, 4, 5)]
    return fits[0].unionByName(fits[1]).unionByName(fits[2])


@register("kmeans_cluster")
def q_kmeans_cluster(t):
    """Cluster of every day for k = 3, 4 and 5 (H6)."""
    return _clusters(t)


@register("kmeans_cluster_totals", with_views("""
    SELECT k, CAST(k AS BIGINT) AS n_clusters, count(*) AS n, count(*) AS n_nearest
    FROM features, (VALUES (3), (4), (5)) v(k) GROUP BY k""", "features"))
def q_kmeans_totals(t):
    """Every day has one of k clusters, and at convergence that of the nearest cluster mean."""
    rows = _clusters(t)
    means = rows.groupBy("k", "cluster").agg(F.avg("pc1").alias("m1"), F.avg("pc2").alias("m2"))
    # At most twelve means: joined to the days of their k.
    apart = rows.join(F.broadcast(means.withColumnRenamed("cluster", "c")), "k")
    distance = F.pow(F.col("pc1") - F.col("m1"), 2) + F.pow(F.col("pc2") - F.col("m2"), 2)
    own = F.max(F.when(F.col("c") == F.col("cluster"), distance))
    day = apart.groupBy("k", "Date", "cluster").agg(own.alias("own"), F.min(distance).alias("least"))
    return day.groupBy("k").agg(F.countDistinct("cluster").alias("n_clusters"), F.count(F.lit(1)).alias("n"),
                                F.count_if(F.col("own") <= F.col("least") + 0.01).alias("n_nearest"))


FLAG_SQL = "SELECT count(*) AS n, CAST({cut} AS BIGINT) AS n_flagged{more} FROM features"


def _flag_totals(out, *more):
    return out.agg(F.count(F.lit(1)).alias("n"), F.sum("anomaly").cast("long").alias("n_flagged"), *more)


def _as_flagged(points):
    """Given the clusters, distances and flags follow: each day's distance from the mean of its
    cluster, and the flag of the int(5 %) farthest (but for days at the very cut)."""
    means = points.groupBy("cluster").agg(F.avg("pc1").alias("m1"), F.avg("pc2").alias("m2"))
    far = points.join(means, "cluster").withColumn("distance", F.sqrt(F.pow(F.col("pc1") - F.col("m1"), 2) + F.pow(F.col("pc2") - F.col("m2"), 2)))
    whole = Window.partitionBy()
    cut = F.floor(0.05 * F.count(F.lit(1)).over(whole))
    far = far.withColumn("_least", F.when(F.row_number().over(Window.orderBy(F.desc("distance"))) <= cut, F.col("distance")))
    apart = F.col("distance") - F.min("_least").over(whole)
    return far.withColumn("agrees", (F.abs(apart) < 0.002) | ((apart > 0) == (F.col("anomaly") == 1)))


@register("kmeans_outliers_totals", with_views(FLAG_SQL.format(cut="floor(0.05 * count(*))", more=", count(*) AS n_agree"), "features"))
def q_kmeans_outliers_totals(t):
    """int(5 %) of the days are flagged, and they are the farthest from their clusters' means."""
    return _flag_totals(_as_flagged(materialize(q_kmeans_outliers(t))), F.count_if("agrees").alias("n_agree"))


@register("cluster_points_totals", with_views(FLAG_SQL.format(cut="floor(0.05 * count(*))", more=", count(*) AS n_agree"), "features"))
def q_cluster_points_totals(t):
    """The points as text say the same: clusters and flags read back agree with the distances."""
    points = materialize(q_cluster_points(t)).select(F.col("principal_component_1").alias("pc1"), F.col("principal_component_2").alias("pc2"),
                                                     F.col("cluster").cast("int").alias("cluster"), F.col("anomaly").cast("int").alias("anomaly"))
    return _flag_totals(_as_flagged(points), F.count_if("agrees").alias("n_agree"))


@register("autoencoder_totals", with_views(FLAG_SQL.format(cut="count(*) - 1 - floor(0.95 * (count(*) - 1))", more=""), "features"))
def q_autoencoder_totals(t):
    """The days above the 95th percentile of the reconstruction error are flagged."""
    return _flag_totals(q_autoencoder(t))


@register("kmeans_outliers")
def q_kmeans_outliers(t):
    return O.kmeans_outliers(daily_features(t), KM_FEATURES, k=4, day_grain=True)


@register("cluster_points")
def q_cluster_points(t):
    """PC1, PC2 with cluster and flag as text, ready for a scatter plot."""
    out = O.kmeans_outliers(daily_features(t), KM_FEATURES, k=4, day_grain=True)
    return out.select(F.col("pc1").alias("principal_component_1"), F.col("pc2").alias("principal_component_2"),
                      F.col("cluster").cast("string").alias("cluster"),
                      F.col("anomaly").cast("string").alias("anomaly"))


@register("isolation_forest")
def q_isolation_forest(t):
    """Isolation forest on the five standardised daily features (H8)."""
    from chainmetrics.operators.isoforest import isolation_forest
    z = FE.standard_scale(daily_features(t), FEATURES, suffix="_z")
    # Days tell rows with equal features apart.
    z = z.withColumn("_day", F.datediff("Date", F.lit("1970-01-01").cast("date")))
    out = isolation_forest(z, [c + "_z" for c in FEATURES], id_col="_day", day_grain=True)
    return out.select("Date", *FEATURES, "score", "anomaly")


@register("autoencoder_outliers")
def q_autoencoder(t):
    """Auto-encoder reconstruction error on the five daily features."""
    from chainmetrics.operators.autoencoder import autoencoder_outliers
    out = autoencoder_outliers(daily_features(t), FEATURES, day_grain=True)
    return out.select("Date", *FEATURES, "score", "anomaly")


# -- knees and stored sketches -------------------------------------------------------

CURVES_SQL = """
    curves AS (SELECT 'supply' AS curve, date_diff('day', DATE '1990-01-01', Date) AS x, round(circulating_supply, 3) AS y FROM basic
               UNION ALL SELECT 'volume', row_number() OVER (ORDER BY tv_usd DESC, Date), round(sum(tv_usd) OVER (ORDER BY tv_usd DESC, Date), 0) FROM basic),
    diff AS (SELECT curve, x, round((y - min(y) OVER c) / (max(y) OVER c - min(y) OVER c) - (x - min(x) OVER c) / (max(x) OVER c - min(x) OVER c), 9) AS d,
                    1.0 / (count(*) OVER c - 1) AS fall FROM curves WINDOW c AS (PARTITION BY curve)),
    tops AS (SELECT *, coalesce(d > lag(d) OVER o AND d >= lead(d) OVER o, false) AS top FROM diff WINDOW o AS (PARTITION BY curve ORDER BY x)),
    parts AS (SELECT *, sum(CASE WHEN top THEN 1 ELSE 0 END) OVER (PARTITION BY curve ORDER BY x) AS part FROM tops)"""


@register("curve_knees", with_views("@", "basic").replace("\n@", "," + CURVES_SQL + """
    SELECT curve, CAST(min(x) AS BIGINT) AS x, round(max(CASE WHEN top THEN d END), 6) AS height FROM parts WHERE part > 0
    GROUP BY curve, part HAVING min(d) < max(CASE WHEN top THEN d END) - min(fall)"""))
def q_curve_knees(t):
    """All knees of two daily curves: circulating supply over time (many maxima), and the share of
    the volume that the largest days hold (H5)."""
    basic, _ = tables(t)
    basic = materialize(basic.select("Date", "circulating_supply", "tv_usd"))
    large = Window.orderBy(F.desc("tv_usd"), "Date")
    curves = (basic.select(F.lit("supply").alias("curve"), F.datediff("Date", F.lit("1990-01-01").cast("date")).cast("long").alias("x"),
                           F.round("circulating_supply", 3).alias("y"))
              .unionByName(basic.select(F.lit("volume").alias("curve"), F.row_number().over(large).cast("long").alias("x"), F.round(F.sum("tv_usd").over(large), 0).alias("y"))))
    return O.knees(curves, by=("curve",)).withColumn("height", F.round("height", 6))


#: Day ranges of the stored cuts.
CUT_RANGES = (("1992-01-01", "1999-12-31"), ("1995-03-01", "1996-02-29"), ("1997-07-01", "1997-07-31"))


@register("stored_cuts", with_views(" UNION ALL ".join(f"""
    SELECT DATE '{a}' AS start_day, DATE '{b}' AS end_day, CAST(max(floor(0.05 * n)) AS BIGINT) AS n,
           {sql_rnd('min(CASE WHEN rn <= floor(0.05 * n) THEN output_total_usd END)', RATIO)} AS threshold
    FROM (SELECT output_total_usd, row_number() OVER (ORDER BY output_total_usd DESC) AS rn, count(*) OVER () AS n
          FROM transactions WHERE Date BETWEEN DATE '{a}' AND DATE '{b}')""" for a, b in CUT_RANGES), "transactions"))
def q_stored_cuts(t):
    """The 5 % cut of transaction volumes in three day ranges, from quantile sketches stored by day."""
    path = scratch_path(t.spark, "scores")
    A.transactions(t.lineitem, t.orders).select("Date", "output_total_usd").write.parquet(f"{path}/scores")
    scores = t.spark.read.parquet(f"{path}/scores")
    O.day_sketches(scores, "output_total_usd").write.parquet(f"{path}/sketches")
    sketches = t.spark.read.parquet(f"{path}/sketches")
    rows = [(a, b, *O.range_cut(scores, sketches, "output_total_usd", a, b)) for a, b in CUT_RANGES]
    out = t.spark.createDataFrame(rows, "a string, b string, n long, threshold double")
    return round_all(out.select(F.col("a").cast("date").alias("start_day"), F.col("b").cast("date").alias("end_day"), "n", "threshold"), {"threshold": RATIO})
