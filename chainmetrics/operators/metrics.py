"""Daily base metrics and valuation metrics.

Two ways in:

* the per-metric operators (``sopr``, ``daily_chain_rollup``, ``basic_metrics``,
  ``thermocap`` ...) take the chain tables and mirror the upstream definitions
  one by one;
* ``day_facts`` + ``basic_from_facts`` + ``computed_metrics`` is the fused plan
  used for the full pipeline: every output-side daily sum (created, spent,
  by order day) comes out of ONE aggregation over the line-grain join, so the
  fact data is shuffled once (the join) and the aggregation shuffle carries
  only partial per-day rows.

Windows over ``Date`` without a partition key run in one task; they are only
ever applied to day-grain frames (one row per calendar day, a few thousand rows
for the whole chain history), never at fact grain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainmetrics.functions import chain as X

BASIC_COLUMNS = ("cost_per_tx", "atv", "cdd", "circulating_supply", "difficulty",
                 "price", "tx_count", "tv_btc", "tv_usd")

COMPUTED_COLUMNS = (
    "market_cap", "realised_cap", "realised_price", "nvt", "sopr", "thermocap", "mvrv",
    "nupl", "relative_unrealised_profit", "velocity", "net_realised_profit_loss",
    "coin_dormancy", "mc_thermocap_ratio", "transferred_price", "balanced_price",
    "investor_cap",
)

# The display names of the metric tables, as the dashboard and the
# metric catalogue spell them.
DISPLAY_NAMES = {
    "Date": "Date",
    "cost_per_tx": "Cost Per Transaction",
    "atv": "Average Transaction Value (ATV)",
    "cdd": "Coin-Days-Destroyed (CDD)",
    "circulating_supply": "Circulating Supply",
    "difficulty": "Difficulty",
    "price": "Price ($)",
    "tx_count": "Transaction Count",
    "tv_btc": "Transaction Volume (BTC)",
    "tv_usd": "Transaction Volume (USD)",
    "market_cap": "Market Capitalisation",
    "realised_cap": "Realised Capitalisation",
    "realised_price": "Realised Price",
    "nvt": "Network Value to Transaction (NVT)",
    "sopr": "Spent Output Profit Ratio (SOPR)",
    "thermocap": "Thermocap",
    "mvrv": "Market Value to Realised Value Ratio (MVRV)",
    "nupl": "Net Unrealised Profit and Loss (NUPL)",
    "relative_unrealised_profit": "Relative Unrealised Profit",
    "velocity": "Velocity",
    "net_realised_profit_loss": "Net Realised Profit/Loss",
    "coin_dormancy": "Average Coin Dormancy",
    "mc_thermocap_ratio": "Market Cap to Thermocap Ratio",
    "transferred_price": "Transferred Price",
    "balanced_price": "Balanced Price",
    "investor_cap": "Investor Capitalisation",
}


def with_display_names(df: DataFrame) -> DataFrame:
    """snake_case -> display names (B13); unknown columns are kept as they are."""
    return df.withColumnsRenamed({c: DISPLAY_NAMES[c] for c in df.columns if c in DISPLAY_NAMES})


def _by_day() -> Window:
    # Day-grain only (see module doc).
    return Window.orderBy("Date")


def running_sum(col, before_only: bool = False):
    frame = (_by_day().rowsBetween(Window.unboundedPreceding, -1) if before_only
             else _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum(col).over(frame)


# --------------------------------------------------------------------------
# Fused plan
# --------------------------------------------------------------------------

def day_facts(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """All raw daily sums in one pass over the line-grain frame.

    Each line contributes up to three rows (creation day, spend day, order day)
    through a generator and each order one row (its day); a single hash
    aggregation over the union, with map-side partial aggregation, reduces them
    per day. One shuffle of at most (days x map tasks) partial rows.
    """
    dbl = F.lit(None).cast("double")
    cdd = F.col("value_btc") * F.datediff("spent", "created")
    def row(date, kind, btc, usd, x, y):
        return F.struct(date.alias("Date"), F.lit(kind).alias("kind"), btc.alias("btc"),
                        usd.alias("usd"), x.alias("x"), y.alias("y"))

    v_btc, v_usd = F.col("value_btc"), F.col("value_usd")
    line_rows = lines.select(F.inline(F.array(
        row(F.col("created"), 0, v_btc, v_usd, dbl, dbl),
        row(F.col("spent"), 1, v_btc, v_usd, F.col("spending_value_usd"), cdd),
        row(F.col("order_day"), 2, v_btc, F.col("fee_usd"), dbl, dbl),
    )))
    order_rows = orders.select(F.inline(F.array(
        row(F.col("o_orderdate").cast("date"), 3, dbl, F.col("o_totalprice"), dbl, dbl))))
    rows = line_rows.unionByName(order_rows).where(F.col("Date").isNotNull())

    def on(kind, c):
        return F.when(F.col("kind") == kind, c)

    return rows.groupBy("Date").agg(
        F.count(on(0, F.lit(1))).alias("n_created"),
        F.sum(on(0, F.col("btc"))).alias("created_btc"),
        F.sum(on(0, F.col("usd"))).alias("created_usd"),
        F.max(on(0, F.col("usd"))).alias("max_created_usd"),
        F.count(on(1, F.lit(1))).alias("n_spent"),
        F.sum(on(1, F.col("btc"))).alias("spent_btc"),
        F.sum(on(1, F.col("usd"))).alias("spent_usd"),
        F.sum(on(1, F.col("x"))).alias("spent_value_usd"),
        F.sum(on(1, F.col("y"))).alias("cdd"),
        F.sum(on(2, F.col("btc"))).alias("line_btc"),
        F.sum(on(2, F.col("usd"))).alias("line_fee_usd"),
        F.count(on(3, F.lit(1))).alias("n_tx"),
        F.sum(on(3, F.col("usd"))).alias("order_usd"),
        F.avg(on(3, F.col("usd"))).alias("atv"),
    )


def daily_state(facts: DataFrame) -> DataFrame:
    """Running state per activity day: circulating supply and realised cap.

    Realised cap on day D = value of outputs created on or before D minus those
    spent before D (an output spent on D still counts on D).
    """
    zero = F.lit(0.0)
    return facts.withColumns({
        "circulating_supply": running_sum(F.coalesce("created_btc", zero)),
        "rc_usd": running_sum(F.coalesce("created_usd", zero))
        - F.coalesce(running_sum(F.coalesce("spent_usd", zero), True), zero),
        "rc_btc": running_sum(F.coalesce("created_btc", zero))
        - F.coalesce(running_sum(F.coalesce("spent_btc", zero), True), zero),
    })


def basic_from_facts(state: DataFrame, extra=()) -> DataFrame:
    """The nine-column basic metric table (days with creations, spends and transactions).

    ``extra`` columns of the state frame are carried along.
    """
    zero = F.lit(0.0)
    return (state.where((F.col("n_created") > 0) & (F.col("n_spent") > 0) & (F.col("n_tx") > 0))
            .select("Date",
                    (F.coalesce("line_fee_usd", zero) / F.col("n_tx")).alias("cost_per_tx"),
                    "atv", "cdd", "circulating_supply",
                    F.col("max_created_usd").alias("difficulty"),
                    X.safe_div("created_usd", "created_btc").alias("price"),
                    F.col("n_tx").alias("tx_count"),
                    F.coalesce("line_btc", zero).alias("tv_btc"),
                    F.col("order_usd").alias("tv_usd"), *extra))


def daily_series(state: DataFrame) -> dict:
    """The nine one-metric day series (Date, value) of the basic table, each on
    the days where it exists: transaction series on transaction days, CDD on
    spend days, price / difficulty / supply on creation days.

    ``state`` is read nine times: materialise it first (it is day grain).
    """
    zero = F.lit(0.0)
    tx_days = state.where(F.col("n_tx") > 0)
    spent_days = state.where(F.col("n_spent") > 0)
    created_days = state.where(F.col("n_created") > 0)
    return {
        "cost_per_tx": tx_days.select("Date", (F.coalesce("line_fee_usd", zero) / F.col("n_tx"))
                                      .alias("cost_per_tx")),
        "atv": tx_days.select("Date", "atv"),
        "cdd": spent_days.select("Date", "cdd"),
        "circulating_supply": created_days.select("Date", "circulating_supply"),
        "difficulty": created_days.select("Date", F.col("max_created_usd").alias("difficulty")),
        "price": created_days.select("Date", X.safe_div("created_usd", "created_btc").alias("price")),
        "tx_count": tx_days.select("Date", F.col("n_tx").alias("tx_count")),
        "tv_btc": tx_days.select("Date", F.coalesce("line_btc", zero).alias("tv_btc")),
        "tv_usd": tx_days.select("Date", F.col("order_usd").alias("tv_usd")),
    }


def sopr_from_facts(facts: DataFrame) -> DataFrame:
    return (facts.where(F.col("n_spent") > 0)
            .select("Date", X.safe_div("spent_value_usd", "spent_usd").alias("sopr")))


def realised_cap_from_state(state: DataFrame) -> DataFrame:
    return state.select("Date", "rc_usd", "rc_btc")


# --------------------------------------------------------------------------
# Per-metric operators
# --------------------------------------------------------------------------

def sopr(inputs: DataFrame) -> DataFrame:
    """Spent output profit ratio per spend day (D1): one grouped pass, no day loop."""
    return (inputs.groupBy(F.col("spent").alias("Date"))
            .agg(X.safe_div(F.sum("spending_value_usd"), F.sum("value_usd")).alias("sopr")))


def daily_cdd(inputs: DataFrame) -> DataFrame:
    return inputs.groupBy(F.col("spent").alias("Date")).agg(F.sum("cdd").alias("cdd"))


def daily_outputs(outputs: DataFrame) -> DataFrame:
    """Per creation day: difficulty stand-in (max output USD), price, circulating supply."""
    d = (outputs.groupBy(F.col("created").alias("Date"))
         .agg(F.max("value_usd").alias("difficulty"),
              X.safe_div(F.sum("value_usd"), F.sum("value_btc")).alias("price"),
              F.sum("value_btc").alias("created_btc")))
    return d.withColumn("circulating_supply", running_sum("created_btc")).drop("created_btc")


def daily_chain_rollup(tx: DataFrame) -> DataFrame:
    """Transaction-side daily series (D3): average fee, average value, count, volumes."""
    return tx.groupBy("Date").agg(
        F.avg("fee_usd").alias("cost_per_tx"),
        F.avg("output_total_usd").alias("atv"),
        F.count(F.lit(1)).alias("tx_count"),
        F.sum("output_total").alias("tv_btc"),
        F.sum("output_total_usd").alias("tv_usd"),
    )


def join_series(frames, on: str = "Date", how: str = "inner") -> DataFrame:
    """Fold of daily frames by equi-join on the day column.

    Every frame is day grain, so each join is between two calendar-bounded
    sides; AQE turns them into broadcast joins at run time.
    """
    frames = list(frames.values()) if isinstance(frames, dict) else list(frames)
    return reduce(lambda a, b: a.join(b, on, how), frames)


def basic_metrics(daily_tx: DataFrame, cdd: DataFrame, outputs_daily: DataFrame) -> DataFrame:
    j = join_series([daily_tx, cdd, outputs_daily])
    return j.select("Date", *BASIC_COLUMNS)


def thermocap(basic: DataFrame) -> DataFrame:
    """All-time sum of miner revenue (E1): running sum of fee x count.

    Exact duplicate day rows (a day loaded twice) are collapsed first (D7).
    """
    d = basic.select("Date", "cost_per_tx", "tx_count").dropDuplicates()
    return d.select("Date", running_sum(F.col("cost_per_tx") * F.col("tx_count")).alias("thermocap"))


def cumulative_cdd(basic: DataFrame, genesis: str = X.CHAIN_GENESIS) -> DataFrame:
    """Running sum of CDD valued at the day's price, with the day number.

    Exact duplicate day rows are collapsed first (D7).
    """
    d = basic.select("Date", "cdd", "price").dropDuplicates()
    return d.select("Date",
                    running_sum(F.col("cdd") * F.col("price")).alias("cum_cdd_usd"),
                    X.day_number("Date", genesis).alias("n_days"))


def _valuation(j: DataFrame, keep=()) -> DataFrame:
    """The 16-column projection over a day frame holding the basic columns,
    rc_usd, rc_btc, sopr, thermocap, cum_cdd_usd and n_days (plus ``keep``)."""
    j = j.withColumns({"market_cap": X.market_cap(), "realised_price": X.realised_price()})
    j = j.withColumns({"nvt": X.nvt(), "transferred_price": X.transferred_price()})
    return j.select(
        "Date", "market_cap",
        F.col("rc_usd").alias("realised_cap"),
        "realised_price", "nvt", "sopr", "thermocap",
        X.mvrv().alias("mvrv"),
        X.nupl().alias("nupl"),
        X.relative_unrealised_profit().alias("relative_unrealised_profit"),
        X.velocity().alias("velocity"),
        X.net_realised_profit_loss().alias("net_realised_profit_loss"),
        X.coin_dormancy().alias("coin_dormancy"),
        X.thermocap_ratio().alias("mc_thermocap_ratio"),
        "transferred_price",
        X.balanced_price().alias("balanced_price"),
        X.investor_cap().alias("investor_cap"),
        *[c for c in keep if c not in ("sopr", "thermocap")],
    )


def _with_running_sums(basic: DataFrame, genesis: str) -> DataFrame:
    return basic.withColumns({
        "thermocap": running_sum(F.col("cost_per_tx") * F.col("tx_count")),
        "cum_cdd_usd": running_sum(F.col("cdd") * F.col("price")),
        "n_days": X.day_number("Date", genesis),
    })


def computed_metrics(basic: DataFrame, realised_cap: DataFrame, sopr_df: DataFrame,
                     genesis: str = X.CHAIN_GENESIS) -> DataFrame:
    """The 16 valuation metrics of all days of the stored daily tables (C2), inner-joined on Date."""
    return computed_from_tables(basic, realised_cap, sopr_df, running_state(basic), genesis)


def running_state(basic: DataFrame, state: DataFrame | None = None, start=None, end=None) -> DataFrame:
    """(Date, thermocap, cum_cdd_usd) of the basic days in ``start .. end``, the running sums
    carried on from the last day of ``state`` before ``start``: a daily run reads its own
    days and one stored row, not the history."""
    if start is not None:
        basic = basic.where(F.col("Date") >= F.lit(start).cast("date"))
    if end is not None:
        basic = basic.where(F.col("Date") <= F.lit(end).cast("date"))
    sums = basic.select("Date", running_sum(F.col("cost_per_tx") * F.col("tx_count")).alias("thermocap"),
                        running_sum(F.col("cdd") * F.col("price")).alias("cum_cdd_usd"))
    if state is None or start is None:
        return sums
    before = state.where(F.col("Date") < F.lit(start).cast("date"))

    def carried(c):
        return F.coalesce(before.select(F.max_by(c, "Date")).scalar(), F.lit(0.0))

    return sums.select("Date", *[(F.col(c) + carried(c)).alias(c) for c in ("thermocap", "cum_cdd_usd")])


def computed_from_tables(basic: DataFrame, realised_cap: DataFrame, sopr_df: DataFrame, state: DataFrame,
                         genesis: str = X.CHAIN_GENESIS) -> DataFrame:
    """The 16 valuation metrics of the days in ``state`` from the stored daily tables."""
    days = basic.join(state, "Date").withColumn("n_days", X.day_number("Date", genesis))
    return _valuation(days.join(realised_cap.select("Date", "rc_usd", "rc_btc"), "Date").join(sopr_df, "Date"))


def chain_metrics_wide(lineitem: DataFrame, orders: DataFrame, genesis: str = X.CHAIN_GENESIS) -> DataFrame:
    """One day frame with the 9 basic and the 16 valuation columns.

    One join, one fact-grain aggregation; every later step is a linear chain of
    day-grain windows and projections (no self-joins, so the fact work is not
    repeated per branch). Readers that need both tables take this frame.
    """
    from chainmetrics.sources.adapters import order_lines
    facts = day_facts(order_lines(lineitem, orders), orders)
    state = daily_state(facts)
    days = basic_from_facts(state, extra=(
        "rc_usd", "rc_btc", X.safe_div("spent_value_usd", "spent_usd").alias("sopr")))
    return _valuation(_with_running_sums(days, genesis), keep=BASIC_COLUMNS)


def chain_metrics(lineitem: DataFrame, orders: DataFrame, genesis: str = X.CHAIN_GENESIS):
    """Fused pipeline from the fact tables. Returns (basic_metrics, computed_metrics);
    use one of them per plan (or ``chain_metrics_wide``) so the facts are read once."""
    wide = chain_metrics_wide(lineitem, orders, genesis)
    return wide.select("Date", *BASIC_COLUMNS), wide.select("Date", *COMPUTED_COLUMNS)
