"""Registered queries: label feeds, de-duplication and the labelled inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainmetrics.operators import labels as L
from chainmetrics.plans.registry import VIEWS, register, with_views
from chainmetrics.plans.rounding import RATIO, USD, round_all, sql_rnd
from chainmetrics.session import scratch_path
from chainmetrics.sources import adapters as A
from chainmetrics.sources import dumps as D

KEEP = ", ".join(str(c) for c in L.ILLICIT_CATEGORIES)

VIEWS.update({
    "category_labels": (f"SELECT account, 1 AS label FROM category_feed WHERE label IN ({KEEP})",
                        ("category_feed",)),
    "report_labels": ("SELECT account, 1 AS label FROM abuse_reports", ("abuse_reports",)),
    "label_union": ("""
        SELECT account, label, 'category' AS source FROM category_labels
        UNION ALL
        SELECT account, label, 'reports' AS source FROM report_labels""",
                    ("category_labels", "report_labels")),
    "illicit": ("""
        SELECT account, arg_min(label, source) AS label, min(source) AS source
        FROM label_union GROUP BY account""", ("label_union",)),
    "labelled_inputs": ("""
        SELECT i.hash, i.account, i.created, i.spent, i.value_btc, i.value_usd, i.spending_value_usd,
               i.fee_usd, i.lifespan, i.cdd, t.input_count, t.output_total, t.output_total_usd,
               t.fee_usd AS tx_fee_usd, CAST(coalesce(l.label, 0) AS INTEGER) AS label
        FROM inputs i LEFT JOIN illicit l ON i.account = l.account
        JOIN transactions t ON i.hash = t.hash""", ("inputs", "illicit", "transactions")),
})

FEATURES = ("value_btc", "value_usd", "spending_value_usd", "fee_usd", "lifespan", "cdd",
            "input_count", "output_total", "output_total_usd", "tx_fee_usd")
LABELLED_SPEC = {"output_total": RATIO, "tx_fee_usd": USD}


def feeds(t):
    return {
        "category": L.category_labels(A.category_feed(t.customer)),
        "reports": L.report_labels(A.abuse_reports(t.events)),
    }


def illicit(t):
    return L.illicit_label_table(feeds(t))


def labelled_inputs(t):
    lines = A.order_lines(t.lineitem, t.orders).drop("order_day")
    inputs = A.spent_inputs(lines).withColumnRenamed("order_total_usd", "output_total_usd")
    tx = A.order_totals(t.lineitem)
    joined = L.label_inputs(inputs, illicit(t), tx, ("input_count", "output_total", "fee_usd")).select(
        "hash", "account", "created", "spent", "value_btc", "value_usd", "spending_value_usd", "fee_usd",
        "lifespan", "cdd", "input_count", "output_total", "output_total_usd", "tx_fee_usd", "label")
    # The reference fills every null after the join (B19); keys stay as they are.
    return L.fill_missing(joined, columns=(*FEATURES, "label"))


@register("category_labels", with_views("SELECT account, label FROM category_labels", "category_labels"))
def q_category_labels(t):
    return L.category_labels(A.category_feed(t.customer))


@register("abuse_reports", with_views("""
    SELECT account, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, 1 AS label
    FROM abuse_reports""", "abuse_reports"))
def q_abuse_reports(t):
    """Report feed with its JSON payload flattened to typed columns."""
    reports = L.parse_report_props(A.abuse_reports(t.events).drop("ts"))
    return reports.select("account", "k", F.lit(1).alias("label"))


@register("label_union", with_views("SELECT account, label, source FROM label_union", "label_union"))
def q_label_union(t):
    return L.label_union(feeds(t))


@register("dedupe_labels", with_views("SELECT account, label, source FROM illicit", "illicit"))
def q_dedupe_labels(t):
    return illicit(t)


@register("duplicate_audit", with_views("""
    SELECT account, count(*) AS n FROM label_union GROUP BY account HAVING count(*) > 1""", "label_union"))
def q_duplicate_audit(t):
    return L.duplicate_audit(L.label_union(feeds(t)))


@register("label_inputs", with_views(
    "SELECT hash, account, created, spent, value_btc, value_usd, spending_value_usd, fee_usd, lifespan, cdd, "
    "input_count, " + sql_rnd("output_total", RATIO) + " AS output_total, output_total_usd, "
    + sql_rnd("tx_fee_usd", USD) + " AS tx_fee_usd, label FROM labelled_inputs", "labelled_inputs"))
def q_label_inputs(t):
    return round_all(labelled_inputs(t), LABELLED_SPEC)


@register("value_counts", with_views(
    "SELECT label, count(*) AS n FROM labelled_inputs GROUP BY label", "labelled_inputs"))
def q_value_counts(t):
    return labelled_inputs(t).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register("group_profile", with_views(
    "SELECT label, " + ", ".join(f"{sql_rnd(f'avg({c})', RATIO)} AS avg_{c}" for c in FEATURES)
    + " FROM labelled_inputs GROUP BY label", "labelled_inputs"))
def q_group_profile(t):
    """Mean of every feature per label."""
    prof = labelled_inputs(t).groupBy("label").agg(*[F.avg(c).alias(f"avg_{c}") for c in FEATURES])
    return round_all(prof, {f"avg_{c}": RATIO for c in FEATURES})


# -- label feeds as files ---------------------------------------------------------

@register("explode_report_pages", with_views("SELECT CAST(account AS VARCHAR) AS account, 1 AS label FROM abuse_reports", "abuse_reports"))
def q_report_pages(t):
    """Reports landed as JSON pages ``{"data": [{"address": ..}]}`` of up to 1,000, read back and
    exploded (A14, A6)."""
    reports = t.events.where("event_type = 'error'").select(F.col("user_id").cast("string").alias("address"),
                                                            F.floor(F.col("event_id") / 1000).alias("page"))
    pages = reports.groupBy("page").agg(F.collect_list(F.struct("address")).alias("data")).drop("page")
    path = scratch_path(t.spark, "report-pages")
    D.write_landing(pages, path, fmt="json", day_col=None)
    return L.explode_report_pages(t.spark.read.schema(L.REPORT_PAGE_SCHEMA).json(path))


@register("label_csv", with_views("""
    SELECT CAST(account AS VARCHAR) AS account, label, source FROM (
      SELECT account, 1 AS label, 'category' AS source FROM category_feed WHERE label IN (0, 2, 6, 7, 8, 9)
      UNION ALL SELECT account, 1, 'reports' FROM abuse_reports)""", "category_feed", "abuse_reports"))
def q_label_csv(t):
    """Both label feeds from CSV files: the category file (two of its columns are read) and
    the daily report files with their ``address`` column (A5, A7)."""
    root = scratch_path(t.spark, "label-csv")
    feed = A.category_feed(t.customer).withColumn("name", F.lit("unused")).withColumn("note", F.lit('a "quoted", text'))
    D.write_landing(feed, f"{root}/category", fmt="csv", day_col=None)
    reports = t.events.where("event_type = 'error'").select(F.col("user_id").alias("address"), F.col("ts").cast("date").alias("date"), "event_id")
    D.write_landing(reports, f"{root}/reports", fmt="csv")
    category = (t.spark.read.option("header", True).schema("account STRING, label INT, name STRING, note STRING")
                .csv(f"{root}/category").select("account", "label"))
    return L.label_union({"category": L.category_labels(category), "reports": L.report_labels(D.read_report_csv(t.spark, f"{root}/reports"))})
