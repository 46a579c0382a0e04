"""Read queries behind the dashboard: ranges, search, series, ribbon, pages.

All of them run on the stored day-grain metric tables (or on a table of
flagged rows for the page query); the metric catalogue is a fixed 23-row
dimension and is broadcast.
"""

from __future__ import annotations

import csv
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CATALOGUE_CSV = os.path.join(os.path.dirname(os.path.dirname(__file__)), "assets", "metrics_catalogue.csv")
CATALOGUE_SCHEMA = ("`index` INT, metric_name STRING, `column` STRING, is_computed BOOLEAN, "
                    "description STRING, formula STRING")

# Moving-average windows (in rows) of the difficulty ribbon.
RIBBON_WINDOWS = (14, 25, 40, 60, 90, 128, 200)
DEFAULT_METRIC = "Price ($)"
RIBBON_METRIC = "Difficulty Ribbon"
PRESETS = {"1M": ("months", 1), "6M": ("months", 6), "YTD": ("ytd", 0), "1Y": ("months", 12), "ALL": ("all", 0)}


# -- catalogue -----------------------------------------------------------------

def read_catalogue(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The metric catalogue as a DataFrame.

    By default the 23 rows shipped with the package travel inside the plan (a
    local relation), so no executor needs the driver's files. A catalogue kept
    on shared storage is read with the CSV reader (quoted commas handled).
    """
    if path is None:
        rows = [(int(r["index"]), r["metric_name"], r["column"], r["is_computed"], r["description"],
                 r["formula"]) for r in catalogue_rows()]
        return spark.createDataFrame(rows, CATALOGUE_SCHEMA.replace("`", ""))
    return (spark.read.schema(CATALOGUE_SCHEMA).option("header", True).option("quote", '"')
            .option("escape", '"').csv(path))


def catalogue_rows(path: str = CATALOGUE_CSV) -> list[dict]:
    """Plan-time copy of the catalogue (23 rows) for building column lists."""
    with open(path, newline="") as f:
        return [dict(r, is_computed=r["is_computed"] == "True") for r in csv.DictReader(f)]


def metric_lookup(catalogue: DataFrame, name: str) -> DataFrame:
    """Description, formula and source table flag of one metric."""
    return catalogue.where(F.col("metric_name") == name).select(
        "metric_name", "description", "formula", "is_computed", "column")


# -- filters -------------------------------------------------------------------

def date_range(df: DataFrame, start=None, end=None, col: str = "Date") -> DataFrame:
    """Inclusive ``start <= Date <= end`` (B14); unfiltered unless both bounds are given."""
    if start is None or end is None:
        return df
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def range_preset(df: DataFrame, preset: str, col: str = "Date") -> DataFrame:
    """Last month / 6 months / year-to-date / year / all, relative to the last day present.

    The last day is a whole-frame window maximum: the input is a day axis (one
    row per day), so this stays one small pass, with no join and no second scan.
    """
    kind, n = PRESETS[preset]
    if kind == "all":
        return df
    last = F.col("_last")
    lower = F.add_months(last, -n) if kind == "months" else F.trunc(last, "year")
    return (df.withColumn("_last", F.max(col).over(Window.partitionBy()))
            .where(F.col(col) >= lower).drop("_last"))


def term_predicate(text_col, search: str):
    """Every blank-separated term occurs in the text, case-insensitively."""
    terms = [t for t in search.split(" ")]
    lowered = F.lower(F.col(text_col) if isinstance(text_col, str) else text_col)
    return reduce(lambda a, b: a & b, [F.contains(lowered, F.lit(t.lower())) for t in terms])


def metric_search(catalogue: DataFrame, search: str | None, name_col: str = "metric_name") -> DataFrame:
    """Names matching all search terms, in catalogue order; an empty search lists all names sorted."""
    if not search:
        return catalogue.select(name_col).orderBy(name_col)
    return catalogue.where(term_predicate(name_col, search)).select(name_col)


# -- series ----------------------------------------------------------------------

def difficulty_ribbon(basic: DataFrame, windows=RIBBON_WINDOWS, start=None, end=None,
                      col: str = "difficulty") -> DataFrame:
    """Difficulty plus its moving means over ``windows`` rows, null until a window is full.

    With a range the table is filtered first, so the windows restart inside it
    (E5). Day-grain single-partition window.
    """
    d = date_range(basic.select("Date", col), start, end)
    out = [F.col("Date"), F.col(col)]
    for w in windows:
        frame = Window.orderBy("Date").rowsBetween(-(w - 1), Window.currentRow)
        out.append(F.when(F.count(F.lit(1)).over(frame) == w, F.avg(col).over(frame)).alias(f"d{w}"))
    return d.select(*out)


def long_metrics(df: DataFrame, columns, ids=("Date",)) -> DataFrame:
    """Wide day table -> (ids..., column, value)."""
    return df.unpivot(list(ids), [F.col(c).cast("double").alias(c) for c in columns], "column", "value")


def metric_series(catalogue: DataFrame, basic: DataFrame, computed: DataFrame, names=None,
                  start=None, end=None) -> DataFrame:
    """(Date, metric_name, value) for the chosen metrics (I1), each read from the
    table its ``is_computed`` flag names; default: the price. Pass the same wide
    frame as both tables to read it once."""
    names = [DEFAULT_METRIC] if names is None else list(names)
    if set(names) <= {RIBBON_METRIC}:
        raise ValueError(f"no metric with one series among {names} (see difficulty_ribbon)")
    names = [n for n in names if n != RIBBON_METRIC]  # several series of its own
    rows = [r for r in catalogue_rows() if r["metric_name"] in names]
    if missing := set(names) - {r["metric_name"] for r in rows}:
        raise ValueError(f"not in the catalogue: {sorted(missing)}")
    for r in rows:
        if r["column"] not in (computed if r["is_computed"] else basic).columns:
            raise ValueError(f"{r['metric_name']}: no column {r['column']}")
    if basic is computed:
        # One wide day table: a single unpivot pass (no second read of its plan).
        flag = {r["column"]: r["is_computed"] for r in rows}
        cols = sorted(set(flag) & set(basic.columns))
        longf = (long_metrics(date_range(basic, start, end), cols)
                 .withColumn("is_computed", F.col("column").isin([c for c in cols if flag[c]])))
    else:
        parts = []
        for is_comp, table in ((False, basic), (True, computed)):
            cols = sorted({r["column"] for r in rows if r["is_computed"] == is_comp} & set(table.columns))
            if cols:
                parts.append(long_metrics(date_range(table, start, end), cols)
                             .withColumn("is_computed", F.lit(is_comp)))
        longf = reduce(lambda a, b: a.unionByName(b), parts)
    cat = F.broadcast(catalogue.where(F.col("metric_name").isin(names))
                      .select("metric_name", "column", "is_computed"))
    return longf.join(cat, ["column", "is_computed"]).select("Date", "metric_name", "value")


def outlier_series(df: DataFrame, features, flag: str = "anomaly") -> DataFrame:
    """Per feature: every value, and the value again where the day is flagged."""
    return (long_metrics(df.select("Date", flag, *features), features, ("Date", flag))
            .select("Date", F.col("column").alias("feature"), "value",
                    F.when(F.col(flag) == 1, F.col("value")).alias("outlier_value")))


# -- flagged rows ----------------------------------------------------------------

PREDICTION_COLUMNS = ("y_knn_pred", "y_dtc_pred", "y_xgb_pred")


def flagged_rows(df: DataFrame, columns=("label",) + PREDICTION_COLUMNS) -> DataFrame:
    """Rows where the label or any prediction is non-zero."""
    present = [c for c in columns if c in df.columns]
    return df.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(0)) != 0 for c in present]))


def illicit_accounts_page(df: DataFrame, model: str, columns=None, page_size: int = 10,
                          page: int = 0, order=None, after=None) -> DataFrame:
    """One page of flagged rows with the chosen display columns.

    Default columns: the model's prediction, account, hash, value, USD value.
    Rows are totally ordered by ``order`` (default: the displayed columns) so a
    page is reproducible; the limit is the feature (a page), implemented as a
    top-k (per-partition top-(offset+size), then merged). For deep pages hand over
    ``after``, the ``order`` values of the last row seen, instead of a page number: the
    rows up to it are filtered away and the top-k is as small as one page. (Rows equal to
    ``after`` in all order columns count as seen: order by a unique key.)
    """
    if page_size not in (10, 25, 50, 100):
        raise ValueError("page size must be 10, 25, 50 or 100")
    columns = list(columns or [model, "account", "hash", "value_btc", "value_usd"])
    order = list(order or columns)
    rows = df.select(*columns)
    if after is not None:
        if page or len(after) != len(order):
            raise ValueError("give either a page number or one value for each order column")
        key = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)])
        types = dict(rows.dtypes)
        last = F.struct(*[F.lit(v).cast(types[c]).alias(f"c{i}") for i, (c, v) in enumerate(zip(order, after))])
        return rows.where(key > last).orderBy(*order).limit(page_size)
    return rows.orderBy(*order).offset(page * page_size).limit(page_size)


def model_performance(report: DataFrame, model: str) -> DataFrame:
    """Test accuracy / precision / recall / F1 of one model (I4)."""
    return report.where(F.col("model") == model).select(
        "model", "test_acc", "test_precision", "test_recall", "test_f1score")
