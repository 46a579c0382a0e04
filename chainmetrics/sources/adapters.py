"""How the star-schema test tables play the chain tables.

``lineitem`` rows are outputs (coins) and ``orders`` rows are transactions:

* an output is created on the earlier of order date and ship date and, when the
  line status is ``F``, spent on the later of the two;
* quantity is the coin value, extended price the USD value at creation, the
  discounted+taxed price the USD value when spent, price x tax the fee;
* customers are accounts, error events are abuse reports, customer nations are
  the category feed.

All functions are lazy DataFrame -> DataFrame projections; the single fact-sized
shuffle is the ``lineitem`` x ``orders`` equi-join on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line grain: every output with its transaction's account and day.

    Columns: hash, account, order_day, created, spent, value_btc, value_usd,
    spending_value_usd, fee_usd.
    """
    li = lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount",
                         "l_tax", "l_linestatus", "l_shipdate")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select(*line_columns())


def line_columns() -> list:
    """The columns of ``order_lines`` over line items joined with their orders."""
    first = F.least("o_orderdate", "l_shipdate").cast("date")
    last = F.greatest("o_orderdate", "l_shipdate").cast("date")
    return [
        F.col("l_orderkey").alias("hash"),
        F.col("o_custkey").alias("account"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        first.alias("created"),
        F.when(F.col("l_linestatus") == "F", last).alias("spent"),
        F.col("l_quantity").alias("value_btc"),
        F.col("l_extendedprice").alias("value_usd"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
        .alias("spending_value_usd"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("fee_usd"),
        F.col("o_totalprice").alias("order_total_usd"),
    ]


def utxo(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Every output ever created (spent or not)."""
    return order_lines(lineitem, orders).drop("order_day", "order_total_usd")


def spent_inputs(outputs: DataFrame) -> DataFrame:
    """Spent outputs = transaction inputs, with lifespan (days) and coin-days destroyed."""
    life = F.datediff("spent", "created")
    return (outputs.where(F.col("spent").isNotNull())
            .withColumn("lifespan", life.cast("long"))
            .withColumn("cdd", F.col("value_btc") * life))


def transactions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Transaction grain: hash, Date, output_total_usd, input_count, output_total, fee_usd.

    Line items are pre-aggregated per order key before the join (map-side
    partial aggregation), so the join shuffles one row per order, not per line.
    """
    per_order = (lineitem.groupBy(F.col("l_orderkey").alias("hash"))
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.sum("l_quantity").alias("b"),
                      F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("f")))
    o = orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    j = o.join(per_order, o["o_orderkey"] == per_order["hash"], "left")
    return j.select(
        F.col("o_orderkey").alias("hash"),
        F.col("o_orderdate").cast("date").alias("Date"),
        F.col("o_totalprice").alias("output_total_usd"),
        F.coalesce("n", F.lit(0)).cast("long").alias("input_count"),
        F.coalesce("b", F.lit(0.0)).alias("output_total"),
        F.coalesce("f", F.lit(0.0)).alias("fee_usd"),
    )


def order_totals(lineitem: DataFrame) -> DataFrame:
    """Per transaction: number of outputs, coin total and fee total, straight from
    the line items (hash, input_count, output_total, fee_usd).

    Partial aggregation sends one row per transaction and map task; the result
    is hash-partitioned by the order key like the line join, so joining it back
    onto line-grain rows needs no further shuffle of the lines.
    """
    return lineitem.groupBy(F.col("l_orderkey").alias("hash")).agg(
        F.count(F.lit(1)).alias("input_count"),
        F.sum("l_quantity").alias("output_total"),
        F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("fee_usd"),
    )


def abuse_reports(events: DataFrame) -> DataFrame:
    """Abuse-report feed: one row per report (error event), account may repeat."""
    return (events.where(F.col("event_type") == "error")
            .select(F.col("user_id").alias("account"), F.col("ts"), F.col("props")))


def category_feed(customer: DataFrame, n_categories: int = 13) -> DataFrame:
    """Category file ``(account, label)`` with labels 0..n_categories-1."""
    return customer.select(F.col("c_custkey").alias("account"),
                           (F.col("c_nationkey") % n_categories).cast("int").alias("label"))
