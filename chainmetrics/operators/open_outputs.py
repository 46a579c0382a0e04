"""Realised cap carried from day range to day range.

The store keeps the unspent outputs, in parts by the month of their creation, the running
totals, and the deltas that fall behind the last day. A range brings the outputs created and
the keys spent in it; a spent output is looked up among the open ones of its month, so
only months that the range touches are read and written, and no spent history at all. All
tables of a range are published in one snapshot: a broken run leaves the old state, a
range that is already there isn't counted twice.

An output counts on its day of creation and on its last day, the day it is spent; its value goes the
day after. Spent keys that no open output has are kept in the table ``unknown``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainmetrics.session import materialize
from chainmetrics.sources.snapshots import Change, Snapshots

MONTH, YEAR = "yyyyMM", "yyyy"


def advance(store: Snapshots, created: DataFrame, spent: DataFrame, start: dt.date, end: dt.date) -> dict:
    """Value the days ``start`` .. ``end`` (inclusive).

    ``created``: key, created, value_usd, value_btc; ``spent``: key, created (of the output), spent. Keys
    are unique. Returns the months read and the first day counted (None: nothing was left to do)."""
    known = store.manifest()
    if known:
        upto = store.read("carry").first().upto
        if end <= upto:
            return {"months": [], "from": None}
        start = max(start, upto + dt.timedelta(days=1))
    spark = store.spark
    born = created.where(F.col("created").between(start, end)).select("key", "created", "value_usd", "value_btc")
    gone = spent.where(F.col("spent").between(start, end)).select("key", F.col("created").alias("since"), "spent")
    month = lambda c: F.date_format(c, MONTH)
    months = sorted(r.m for r in born.select(month("created").alias("m")).union(gone.select(month("since"))).distinct().collect() if r.m)
    pool = born.unionByName(store.read("open", months)) if known else born
    # Every touched output and every spent key once: still open, spent, or unknown.
    met = materialize(pool.withColumn("here", F.lit(True)).join(gone, "key", "full"))
    spends = met.where("here and spent is not null")
    deltas = (met.where("here").where(F.col("created") >= F.lit(start)).select(F.col("created").alias("Date"), F.col("value_usd").alias("u"), F.col("value_btc").alias("b"))
              .unionByName(spends.select(F.date_add("spent", 1).alias("Date"), (-F.col("value_usd")).alias("u"), (-F.col("value_btc")).alias("b"))))
    if known:
        deltas = deltas.unionByName(store.read("pending"))
    per_day = materialize(deltas.groupBy("Date").agg(F.sum("u").alias("u"), F.sum("b").alias("b")))
    base = store.read("carry").first() if known else None
    now = per_day.where(F.col("Date") <= F.lit(end))
    run = Window.orderBy("Date")  # the days of one range
    days = now.select("Date", *[(F.sum(c).over(run) + F.lit(float(base[n]) if base else 0.0)).alias(n) for c, n in (("u", "rc_usd"), ("b", "rc_btc"))])
    years = [str(y) for y in range(start.year, end.year + 1)]
    if known:
        days = days.unionByName(store.read("days", years).where(F.col("Date") < F.lit(start)))
    total = now.agg(F.sum("u").alias("u"), F.sum("b").alias("b")).first()
    carry = [(end, (base.rc_usd if base else 0.0) + (total.u or 0.0), (base.rc_btc if base else 0.0) + (total.b or 0.0))]
    store.commit({
        "open": Change(met.where("here and spent is null").select("key", "created", "value_usd", "value_btc"), month("created"), months),
        "days": Change(days, F.date_format("Date", YEAR), years),
        "pending": Change(per_day.where(F.col("Date") > F.lit(end)), whole=True),
        "unknown": Change(met.where("here is null").select("key", "since", "spent"), F.date_format("spent", MONTH)),
        "carry": Change(spark.createDataFrame(carry, "upto date, rc_usd double, rc_btc double").coalesce(1), whole=True),
    })
    return {"months": months, "from": start}


def realised_cap(store: Snapshots) -> DataFrame:
    """(Date, rc_usd, rc_btc) of all days valued so far; pending days are not among them."""
    return store.read("days")
