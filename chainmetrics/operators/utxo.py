"""Interval (UTXO-lifetime) metrics rewritten as day deltas.

Realised cap on day D sums every output alive on D: created on or before D and
unspent or spent on/after D. Written as a range join this is a nested-loop or
cartesian plan (outputs x days). Instead every output becomes two delta rows,
+value on its creation day and -value on the day after its spend, the deltas
are summed per day (hash aggregation with map-side partial sums), and a running
sum over the resulting day-grain frame gives the value per day. Cost is one
scan + one small shuffle, independent of how long outputs live.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _deltas(outputs: DataFrame) -> DataFrame:
    rows = outputs.select(F.inline(F.array(
        F.struct(F.col("created").alias("Date"),
                 F.col("value_usd").alias("u"), F.col("value_btc").alias("b")),
        F.struct(F.date_add("spent", 1).alias("Date"),
                 (-F.col("value_usd")).alias("u"), (-F.col("value_btc")).alias("b")),
    )))
    return rows.where(F.col("Date").isNotNull())


def realised_cap(outputs: DataFrame, spine: DataFrame | None = None) -> DataFrame:
    """(Date, rc_usd, rc_btc) for every day with a delta, plus every ``spine`` day.

    ``spine`` is an optional frame with a ``Date`` column (e.g. a calendar) so
    days without creations or spends still get a value.
    """
    d = _deltas(outputs)
    if spine is not None:
        d = d.unionByName(spine.select("Date").distinct()
                          .select("Date", F.lit(0.0).alias("u"), F.lit(0.0).alias("b")))
    per_day = d.groupBy("Date").agg(F.sum("u").alias("u"), F.sum("b").alias("b"))
    # Day-grain running sum (one row per day).
    w = Window.orderBy("Date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.select("Date", F.sum("u").over(w).alias("rc_usd"),
                          F.sum("b").over(w).alias("rc_btc"))


def circulating_supply(outputs: DataFrame) -> DataFrame:
    """Running total of created coins, read as of each creation day."""
    per_day = outputs.groupBy(F.col("created").alias("Date")).agg(F.sum("value_btc").alias("b"))
    w = Window.orderBy("Date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.select("Date", F.sum("b").over(w).alias("circulating_supply"))
