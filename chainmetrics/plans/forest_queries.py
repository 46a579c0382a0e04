"""Registered query: isolation forest with hash draws, grown and scored by SQL as well."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainmetrics.operators import hash_forest as HF
from chainmetrics.operators import outliers as O
from chainmetrics.operators.isoforest import EULER_GAMMA, SAMPLE, TREES
from chainmetrics.plans.metric_queries import SPEC
from chainmetrics.plans.registry import register, with_views
from chainmetrics.plans.rounding import RATIO, round_all, sql_rnd, sql_select
from chainmetrics.plans.stats_queries import FEATURES, daily_features
from chainmetrics.session import materialize

PLACES = {c: SPEC[c] for c in FEATURES if c in SPEC}
DEPTH = HF.depth_limit(SAMPLE)


def _draw(*parts: str) -> str:
    return f"(CAST(('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 8)) AS BIGINT) + 0.5)::DOUBLE / 4294967296.0::DOUBLE"


def _excess(n: str) -> str:
    return (f"CASE WHEN {n} > 2 THEN 2.0::DOUBLE * (ln({n}::DOUBLE - 1.0) + {EULER_GAMMA!r}::DOUBLE) - 2.0::DOUBLE * ({n}::DOUBLE - 1.0) / {n} "
            f"WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")


def _split(stats: str) -> str:
    """Feature and split of each row of ``stats`` (tree, node, lo, hi, ...); feature is null where nothing varies."""
    return f"""
        SELECT *, lo[feature + 1] + ({_draw("'split'", "tree", "node")}) * (hi[feature + 1] - lo[feature + 1]) AS split
        FROM (SELECT *, free[1 + CAST(floor(({_draw("'feature'", "tree", "node")}) * len(free)) AS INTEGER)] AS feature
              FROM (SELECT *, [i FOR i IN {list(range(len(FEATURES)))} IF hi[i + 1] > lo[i + 1]] AS free FROM ({stats})))"""


def _ends(over: str = "") -> str:
    return ", ".join(f"[{', '.join(f'{f}(x[{i + 1}]){over}' for i in range(len(FEATURES)))}] AS {name}" for f, name in (("min", "lo"), ("max", "hi")))


VIEWS = {
    "points": (f"SELECT *, date_diff('day', DATE '1970-01-01', Date) AS id, [{', '.join(f'{c}::DOUBLE' for c in FEATURES)}] AS x "
               f"FROM (SELECT Date, {sql_select(PLACES, FEATURES)} FROM features)", ("features",)),
    "members": (f"""
        SELECT CAST(t AS INTEGER) AS tree, x, 1::BIGINT AS node, 0 AS depth FROM points, range({TREES}) r(t)
        WHERE {_draw("'row'", "t", "id")} < {SAMPLE}.0::DOUBLE / (SELECT count(*) FROM points)
        UNION ALL
        SELECT tree, x, 2 * node + CASE WHEN x[feature + 1] >= split THEN 1 ELSE 0 END, depth + 1
        FROM ({_split(f"SELECT *, {_ends(' OVER w')} FROM members WHERE depth < {DEPTH} WINDOW w AS (PARTITION BY tree, node)")})
        WHERE feature IS NOT NULL""", ("points",)),
    "nodes": (f"""
        SELECT tree, node, size, CASE WHEN depth < {DEPTH} THEN feature END AS feature, split
        FROM ({_split(f"SELECT tree, node, depth, count(*) AS size, {_ends()} FROM members GROUP BY tree, node, depth")})""", ("members",)),
    "walk": (f"""
        SELECT CAST(t AS INTEGER) AS tree, id, x, 1::BIGINT AS node, 0 AS depth FROM points, range({TREES}) r(t)
        UNION ALL
        SELECT w.tree, id, x, 2 * w.node + CASE WHEN x[feature + 1] >= split THEN 1 ELSE 0 END, depth + 1
        FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE feature IS NOT NULL""", ("points", "nodes")),
    "scores": (f"""
        SELECT id, round(power(2.0::DOUBLE, -(sum(depth + {_excess('coalesce(size, 0)')}) / {TREES}.0::DOUBLE) / ({_excess(str(SAMPLE))})), 9) AS score
        FROM walk w LEFT JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE feature IS NULL GROUP BY id""", ("walk",)),
}


def _sql() -> str:
    # The recursive views name themselves, so they can't be looked up by their dependencies alone.
    return with_views(f"""
        SELECT Date, {sql_rnd('score', RATIO)} AS score, CAST(score >= (SELECT min(score) FROM (
                   SELECT score, row_number() OVER (ORDER BY score DESC) AS rn, count(*) OVER () AS n FROM scores) WHERE rn <= floor(0.05 * n)) AS INTEGER) AS anomaly
        FROM points JOIN scores USING (id)""", "scores", extra=VIEWS).replace("WITH ", "WITH RECURSIVE ", 1)


@register("hash_forest", _sql())
def q_hash_forest(t):
    """Isolation forest with md5 draws on the five daily features, flags for the highest 5 % (H8)."""
    days = materialize(round_all(daily_features(t), PLACES).withColumn("day", F.datediff("Date", F.lit("1970-01-01").cast("date"))))
    nodes = HF.grow(days, FEATURES, "day")
    scored = materialize(HF.score_rows(days, nodes, FEATURES).withColumn("score", F.round("score", 9)))
    return round_all(O.flag_outliers(scored, "score", day_grain=True).select("Date", "score", "anomaly"), {"score": RATIO})
