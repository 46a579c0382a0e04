"""Registered queries: dashboard reads (ranges, ribbon, search, series, pages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainmetrics.functions import common as C
from chainmetrics.operators import metrics as M
from chainmetrics.operators import serving as S
from chainmetrics.plans.label_queries import labelled_inputs
from chainmetrics.plans.metric_queries import SPEC, TEST_GENESIS
from chainmetrics.plans.registry import register, with_views
from chainmetrics.plans.rounding import RATIO, round_all, sql_rnd, sql_select

RANGE = ("1997-01-01", "1997-12-31")
RIBBON_RANGE = ("1997-01-01", "1998-06-30")
PART_SEARCH = "RED ge"
DOC_SEARCH = "Worthless Ore"


def tables(t):
    basic, computed = M.chain_metrics(t.lineitem, t.orders, TEST_GENESIS)
    return basic, computed


@register("date_range_filter", with_views(
    f"SELECT {sql_select(SPEC, ('Date',) + M.BASIC_COLUMNS)} FROM basic "
    f"WHERE Date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'", "basic"))
def q_date_range(t):
    basic, _ = tables(t)
    return round_all(S.date_range(basic, *RANGE), SPEC)


@register("range_preset", with_views(f"""
    SELECT Date, {sql_rnd('price', RATIO)} AS price FROM basic
    WHERE Date >= CAST((SELECT max(Date) FROM basic) - INTERVAL 6 MONTH AS DATE)""", "basic"))
def q_range_preset(t):
    basic, _ = tables(t)
    return round_all(S.range_preset(basic.select("Date", "price"), "6M"), SPEC)


@register("range_preset_ytd", with_views(f"""
    SELECT Date, {sql_rnd('price', RATIO)} AS price FROM basic
    WHERE Date >= date_trunc('year', (SELECT max(Date) FROM basic))""", "basic"))
def q_range_preset_ytd(t):
    basic, _ = tables(t)
    return round_all(S.range_preset(basic.select("Date", "price"), "YTD"), SPEC)


def _preset(key: str, preset: str, condition: str):
    @register(key, with_views(f"SELECT Date, {sql_rnd('price', RATIO)} AS price FROM basic WHERE {condition}", "basic"))
    def q(t):
        """A date preset relative to the last day of the axis."""
        basic, _ = tables(t)
        return round_all(S.range_preset(basic.select("Date", "price"), preset), SPEC)


_preset("range_preset_1m", "1M", "Date >= CAST((SELECT max(Date) FROM basic) - INTERVAL 1 MONTH AS DATE)")
_preset("range_preset_1y", "1Y", "Date >= CAST((SELECT max(Date) FROM basic) - INTERVAL 12 MONTH AS DATE)")
_preset("range_preset_all", "ALL", "true")


def _ribbon_sql(where: str = "") -> str:
    cols = []
    for w in S.RIBBON_WINDOWS:
        frame = f"(ORDER BY Date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        cols.append(f"CASE WHEN count(*) OVER {frame} = {w} THEN "
                    f"{sql_rnd(f'avg(difficulty) OVER {frame}', RATIO)} END AS d{w}")
    return with_views(f"SELECT Date, difficulty, {', '.join(cols)} FROM basic {where}", "basic")


RIBBON_SPEC = {f"d{w}": RATIO for w in S.RIBBON_WINDOWS}


@register("difficulty_ribbon", _ribbon_sql())
def q_ribbon(t):
    basic, _ = tables(t)
    return round_all(S.difficulty_ribbon(basic), RIBBON_SPEC)


@register("difficulty_ribbon_range",
          _ribbon_sql(f"WHERE Date BETWEEN DATE '{RIBBON_RANGE[0]}' AND DATE '{RIBBON_RANGE[1]}'"))
def q_ribbon_range(t):
    basic, _ = tables(t)
    return round_all(S.difficulty_ribbon(basic, start=RIBBON_RANGE[0], end=RIBBON_RANGE[1]), RIBBON_SPEC)


def _terms_sql(col: str, search: str) -> str:
    return " AND ".join(f"contains(lower({col}), '{w.lower()}')" for w in search.split(" "))


@register("metric_search", f"SELECT p_partkey, p_name FROM part WHERE {_terms_sql('p_name', PART_SEARCH)}")
def q_metric_search(t):
    """The name search of the metric list, on a name column that grows with the data."""
    return t.part.where(S.term_predicate("p_name", PART_SEARCH)).select("p_partkey", "p_name")


@register("document_search",
          f"SELECT doc_id, lang, n_chars FROM documents WHERE {_terms_sql('text', DOC_SEARCH)}")
def q_document_search(t):
    """Same predicate over whole document texts."""
    return (t.documents.where(S.term_predicate("text", DOC_SEARCH))
            .select("doc_id", "lang", "n_chars"))


def _series_sql() -> str:
    parts = []
    for r in S.catalogue_rows():
        if r["metric_name"] == S.RIBBON_METRIC:
            continue
        view = "computed" if r["is_computed"] else "basic"
        col = r["column"]
        expr = sql_rnd(col, SPEC[col]) if col in SPEC else col
        name = r["metric_name"].replace("'", "''")
        parts.append(f"SELECT Date, '{name}' AS metric_name, CAST({expr} AS DOUBLE) AS value FROM {view} "
                     f"WHERE Date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'")
    return with_views("\nUNION ALL\n".join(parts), "basic", "computed")


@register("metric_series", _series_sql())
def q_metric_series(t):
    """Every catalogue metric of 1997 as (Date, metric_name, value), dispatched by is_computed."""
    wide = round_all(M.chain_metrics_wide(t.lineitem, t.orders, TEST_GENESIS), SPEC)
    cat = S.read_catalogue(t.spark)
    names = [r["metric_name"] for r in S.catalogue_rows()]
    return S.metric_series(cat, wide, wide, names, *RANGE)


PAGE_COLUMNS = ("label", "account", "hash", "value_btc", "value_usd")


@register("illicit_accounts_page", with_views(f"""
    SELECT {', '.join(PAGE_COLUMNS)} FROM labelled_inputs WHERE label <> 0
    ORDER BY {', '.join(PAGE_COLUMNS)} LIMIT 25 OFFSET 50""", "labelled_inputs"))
def q_accounts_page(t):
    """Third page (25 rows) of labelled inputs flagged illicit, display columns only."""
    flagged = S.flagged_rows(labelled_inputs(t), ("label",))
    return S.illicit_accounts_page(flagged, "label", PAGE_COLUMNS, page_size=25, page=2)


@register("parsed_days", """
    SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y%m%d') AS day_key, string_split(strftime(ts, 'dump_%Y_%m'), '_')[2] AS name_part,
           CASE WHEN value > 50 THEN 1 ELSE 0 END AS is_large FROM events""")
def q_parsed_days(t):
    """Days written day-first or in ISO order are parsed alike; day keys, name parts and flags."""
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "dd/MM/yyyy")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    rows = t.events.select("event_id", "ts", C.parse_day(text).alias("day"), (F.col("value") > 50).alias("large"))
    return rows.select("event_id", "day", C.day_key("day").alias("day_key"), C.name_part(F.date_format("ts", "'dump'_yyyy_MM")).alias("name_part"),
                       C.flag_to_int(F.coalesce("large", F.lit(False))).alias("is_large"))


@register("name_list", "SELECT p_name FROM part ORDER BY p_name")
def q_name_list(t):
    """An empty search lists all names, sorted (F2)."""
    return S.metric_search(t.part, "", "p_name")
