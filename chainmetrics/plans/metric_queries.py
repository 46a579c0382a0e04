"""Registered queries: daily base metrics and valuation metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainmetrics.operators import metrics as M
from chainmetrics.operators import open_outputs as OO
from chainmetrics.operators import utxo as U
from chainmetrics.plans.registry import register, with_views
from chainmetrics.plans.rounding import RATIO, THOUSANDS, USD, WHOLE, round_all, sql_rnd, sql_select
from chainmetrics.session import materialize, scratch_path
from chainmetrics.sources import adapters as A
from chainmetrics.sources import dumps as D
from chainmetrics.sources.snapshots import Change, Snapshots

# Day number origin for the test tables (their first order day).
TEST_GENESIS = "1995-01-01"

BASIC_SPEC = {"cost_per_tx": USD, "atv": USD, "cdd": RATIO, "circulating_supply": RATIO,
              "difficulty": USD, "price": RATIO, "tv_btc": RATIO, "tv_usd": USD}
COMPUTED_SPEC = {
    "market_cap": WHOLE, "realised_cap": WHOLE, "realised_price": RATIO, "nvt": RATIO,
    "sopr": RATIO, "thermocap": WHOLE, "mvrv": RATIO, "nupl": RATIO,
    "relative_unrealised_profit": WHOLE, "velocity": RATIO, "net_realised_profit_loss": WHOLE,
    "coin_dormancy": RATIO, "mc_thermocap_ratio": RATIO, "transferred_price": RATIO,
    "balanced_price": RATIO, "investor_cap": WHOLE,
    "rc_usd": WHOLE, "rc_btc": RATIO, "cum_cdd_usd": THOUSANDS, "tv_usd": USD, "tx_count": None,
}
SPEC = {k: v for k, v in {**BASIC_SPEC, **COMPUTED_SPEC}.items() if v is not None}


def _outputs(t):
    return A.utxo(t.lineitem, t.orders)


def _inputs(t):
    return A.spent_inputs(_outputs(t))


def day_state(t):
    """Single-pass day state of the facts, checkpointed (day grain, thousands of rows)."""
    facts = M.day_facts(A.order_lines(t.lineitem, t.orders), t.orders)
    return materialize(M.daily_state(facts))


def basic_per_metric(t):
    """Basic table the per-metric way: three daily rollups joined on Date."""
    outputs = _outputs(t)
    return M.basic_metrics(M.daily_chain_rollup(A.transactions(t.lineitem, t.orders)),
                           M.daily_cdd(A.spent_inputs(outputs)),
                           M.daily_outputs(outputs))


def _sql(columns, source_view, *views, where: str = "") -> str:
    return with_views(f"SELECT {sql_select(SPEC, columns)} FROM {source_view} {where}", source_view, *views)


# -- flagship ---------------------------------------------------------------

@register("computed_metrics", _sql(("Date",) + M.COMPUTED_COLUMNS, "computed"))
def q_computed_metrics(t):
    """All 16 valuation metrics per day from the fact tables (fused plan)."""
    _, computed = M.chain_metrics(t.lineitem, t.orders, TEST_GENESIS)
    return round_all(computed, SPEC)


@register("basic_metrics", _sql(("Date",) + M.BASIC_COLUMNS, "basic"))
def q_basic_metrics(t):
    """Nine one-metric day series inner-joined on Date (C1); the series come from
    one pass over the facts."""
    joined = M.join_series(M.daily_series(day_state(t)))
    return round_all(joined.select("Date", *M.BASIC_COLUMNS), SPEC)


@register("basic_metrics_fused", _sql(("Date",) + M.BASIC_COLUMNS, "basic"))
def q_basic_metrics_fused(t):
    basic, _ = M.chain_metrics(t.lineitem, t.orders, TEST_GENESIS)
    return round_all(basic, SPEC)


@register("daily_chain_rollup",
          _sql(("Date", "cost_per_tx", "atv", "tx_count", "tv_btc", "tv_usd"), "daily_tx"))
def q_daily_chain_rollup(t):
    return round_all(M.daily_chain_rollup(A.transactions(t.lineitem, t.orders)), SPEC)


@register("sopr", _sql(("Date", "sopr"), "sopr"))
def q_sopr(t):
    return round_all(M.sopr(_inputs(t)), SPEC)


# Oracle = the interval join itself (brute force over outputs x days).
REALISED_CAP_SQL = with_views(f"""
    SELECT d.Date,
           {sql_rnd('coalesce(sum(u.value_usd), 0)', WHOLE)} AS rc_usd,
           {sql_rnd('coalesce(sum(u.value_btc), 0)', RATIO)} AS rc_btc
    FROM (SELECT DISTINCT Date FROM deltas) d
    LEFT JOIN utxo u ON u.created <= d.Date AND (u.spent IS NULL OR u.spent >= d.Date)
    GROUP BY d.Date""", "deltas", "utxo")


@register("realised_cap", REALISED_CAP_SQL)
def q_realised_cap(t):
    return round_all(U.realised_cap(_outputs(t)), SPEC)


@register("circulating_supply", with_views("""
    SELECT created AS Date, round(sum(sum(value_btc)) OVER (ORDER BY created), 6) AS circulating_supply
    FROM utxo GROUP BY created""", "utxo"))
def q_circulating_supply(t):
    return round_all(U.circulating_supply(_outputs(t)), SPEC)


@register("feature_merge",
          _sql(("Date", "tv_usd", "tx_count", "cdd", "circulating_supply", "price"), "basic"))
def q_feature_merge(t):
    """Five one-metric daily series folded by inner join on Date (C4)."""
    series = M.daily_series(day_state(t))
    keep = ("tv_usd", "tx_count", "cdd", "circulating_supply", "price")
    return round_all(M.join_series({k: series[k] for k in keep}), SPEC)


# -- single metrics (B1-B10) and running sums (E1, E2) ----------------------

SINGLE_COLUMNS = {
    "market_cap": ("market_cap",), "nvt_ratio": ("nvt",), "velocity": ("velocity",),
    "net_realised_profit_loss": ("net_realised_profit_loss",), "coin_dormancy": ("coin_dormancy",),
    "realised_price": ("realised_price",), "mvrv_nupl": ("mvrv", "nupl"),
    "relative_unrealised_profit": ("relative_unrealised_profit",),
    "thermocap_ratio": ("mc_thermocap_ratio", "investor_cap"),
    "transferred_balanced_price": ("transferred_price", "balanced_price"),
}


def _register_single(key):
    @register(key, _sql(("Date",) + SINGLE_COLUMNS[key], "computed"))
    def q(t):
        """One valuation metric, read from the single-pass wide day frame."""
        wide = M.chain_metrics_wide(t.lineitem, t.orders, TEST_GENESIS)
        return round_all(wide.select("Date", *SINGLE_COLUMNS[key]), SPEC)
    q.__name__ = f"q_{key}"
    return q


for _k in SINGLE_COLUMNS:
    _register_single(_k)


def _basic(t):
    basic, _ = M.chain_metrics(t.lineitem, t.orders, TEST_GENESIS)
    return basic


@register("thermocap", _sql(("Date", "thermocap"), "metrics_day"))
def q_thermocap(t):
    return round_all(M.thermocap(_basic(t)), SPEC)


@register("cumulative_cdd_usd", with_views(f"""
    SELECT Date, {sql_select(SPEC, ('cum_cdd_usd',))}, CAST(n_days AS INTEGER) AS n_days FROM metrics_day""",
    "metrics_day"))
def q_cumulative_cdd(t):
    return round_all(M.cumulative_cdd(_basic(t), TEST_GENESIS), SPEC)


# -- stored daily tables: full build once, then ranges of days ----------------------

#: First day of the incremental run, and the published range.
NEW_FROM = "1996-07-01"
PUBLISHED = ("1996-01-15", "1997-08-20")


def _store(t):
    """Write the daily tables (basic, realised cap, sopr) as the daily jobs keep them; returns readers."""
    root, state = scratch_path(t.spark, "daily"), day_state(t)
    joined = M.join_series(M.daily_series(state)).select("Date", *M.BASIC_COLUMNS)
    for name, df in (("basic", joined), ("realised_cap", M.realised_cap_from_state(state)), ("sopr", M.sopr_from_facts(state))):
        D.replace_table(df, f"{root}/{name}")
    return root, [t.spark.read.parquet(f"{root}/{n}") for n in ("basic", "realised_cap", "sopr")]


def computed_incrementally(t):
    """Computed metrics of the old days, then of the new ones from their days and the last stored
    running sums; both appended to the computed table."""
    root, (basic, cap, sopr) = _store(t)
    for part, (start, end) in enumerate(((None, "1996-06-30"), (NEW_FROM, None))):
        stored = t.spark.read.parquet(f"{root}/state") if part else None
        D.publish_range(M.running_state(basic, stored, start, end), f"{root}/state")
        days = t.spark.read.parquet(f"{root}/state").drop("year")
        if start:
            days = days.where(F.col("Date") >= start)
        D.publish_range(M.computed_from_tables(basic, cap, sopr, days, TEST_GENESIS), f"{root}/computed")
    return basic, t.spark.read.parquet(f"{root}/computed").drop("year")


@register("computed_from_stored", _sql(("Date",) + M.COMPUTED_COLUMNS, "computed"))
def q_computed_from_stored(t):
    """The incremental daily path (stored tables, running sums carried on) equals the full rebuild."""
    return round_all(computed_incrementally(t)[1].select("Date", *M.COMPUTED_COLUMNS), SPEC)


@register("publish_metrics", _sql(("Date",) + M.COMPUTED_COLUMNS, "computed",
                                  where=f"WHERE Date BETWEEN DATE '{PUBLISHED[0]}' AND DATE '{PUBLISHED[1]}'"))
def q_publish(t):
    """Range extract of the computed table, published sorted by day, in two overlapping parts (F1 + B14 + A8)."""
    path, (_, computed) = scratch_path(t.spark, "published"), computed_incrementally(t)
    D.publish_range(computed, path, PUBLISHED[0], "1997-01-10")
    return round_all(D.publish_range(computed, path, "1996-12-20", PUBLISHED[1]).select("Date", *M.COMPUTED_COLUMNS), SPEC)


# -- state carried between ranges, tables published together ---------------------------

#: Ranges of the carried realised cap, one after another.
RANGES = ((dt.date(1980, 1, 1), dt.date(1996, 6, 30)), (dt.date(1996, 7, 1), dt.date(1996, 7, 1)), (dt.date(1996, 6, 1), dt.date(2040, 1, 1)))


@register("realised_cap_carried", REALISED_CAP_SQL)
def q_realised_cap_carried(t):
    """Realised cap by three ranges (one of a single day, one that overlaps), each on the open
    outputs that the one before left; equal to the interval join (C6)."""
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    same = Window.partitionBy("l_orderkey").orderBy(*t.lineitem.columns)
    key = F.concat_ws("-", "l_orderkey", F.row_number().over(same))
    first, last = (f("o_orderdate", "l_shipdate").cast("date") for f in (F.least, F.greatest))
    facts = materialize(lines.select(key.alias("key"), first.alias("created"), F.when(F.col("l_linestatus") == "F", last).alias("spent"),
                                     F.col("l_extendedprice").alias("value_usd"), F.col("l_quantity").alias("value_btc")))
    store = Snapshots(t.spark, scratch_path(t.spark, "open-outputs"))
    for start, end in RANGES:
        OO.advance(store, facts, facts.where("spent is not null"), start, end)
    return round_all(OO.realised_cap(store), SPEC)


@register("publish_snapshot", with_views(
    f"SELECT {sql_select(SPEC, ('Date', 'price', *M.COMPUTED_COLUMNS))} FROM basic JOIN computed USING (Date)", "basic", "computed"))
def q_publish_snapshot(t):
    """Basic and computed metrics published together, in two loads of which the second replaces the
    overlapping years of both tables; read from one snapshot (A4, A8)."""
    basic, computed = (materialize(df) for df in M.chain_metrics(t.lineitem, t.orders, TEST_GENESIS))
    store = Snapshots(t.spark, scratch_path(t.spark, "published"))
    year = F.date_format("Date", "yyyy")
    for where in ("Date < DATE '1998-01-01'", "Date >= DATE '1997-01-01'"):
        store.commit({"basic": Change(basic.where(where), year), "computed": Change(computed.where(where), year)})
    store.vacuum()
    version = store.version()
    both = store.read("basic", version=version).select("Date", "price").join(store.read("computed", version=version), "Date")
    return round_all(both.select("Date", "price", *M.COMPUTED_COLUMNS), SPEC)


@register("display_names", with_views(
    "SELECT " + ", ".join(f"{sql_rnd(c, SPEC[c]) if c in SPEC else c} AS \"{M.DISPLAY_NAMES[c]}\"" for c in ("Date", *M.BASIC_COLUMNS)) + " FROM basic", "basic"))
def q_display_names(t):
    """The basic table under the names that are shown."""
    return M.with_display_names(q_basic_metrics_fused(t))
