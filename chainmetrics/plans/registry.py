"""Registry of named queries (Spark) and their SQL oracles (DuckDB dialect)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainmetrics.session import ship_package
from chainmetrics.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` as query ``name``."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(Tables(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# Oracle views mirroring chainmetrics.sources.adapters, in dependency order.
# Each entry: name -> (SQL body, dependencies).
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "utxo": ("""
        SELECT l_orderkey AS hash, o_custkey AS account,
               CAST(o_orderdate AS DATE) AS order_day,
               CAST(least(o_orderdate, l_shipdate) AS DATE) AS created,
               CASE WHEN l_linestatus = 'F' THEN CAST(greatest(o_orderdate, l_shipdate) AS DATE) END AS spent,
               l_quantity AS value_btc, l_extendedprice AS value_usd,
               l_extendedprice * (1 - l_discount) * (1 + l_tax) AS spending_value_usd,
               l_extendedprice * l_tax AS fee_usd
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""", ()),
    "inputs": ("""
        SELECT *, CAST(date_diff('day', created, spent) AS BIGINT) AS lifespan,
               value_btc * date_diff('day', created, spent) AS cdd
        FROM utxo WHERE spent IS NOT NULL""", ("utxo",)),
    "transactions": ("""
        SELECT o_orderkey AS hash, CAST(o_orderdate AS DATE) AS Date, o_totalprice AS output_total_usd,
               CAST(coalesce(n, 0) AS BIGINT) AS input_count, coalesce(b, 0.0) AS output_total,
               coalesce(f, 0.0) AS fee_usd
        FROM orders LEFT JOIN (SELECT hash, count(*) AS n, sum(value_btc) AS b, sum(fee_usd) AS f
                               FROM utxo GROUP BY hash) u ON u.hash = o_orderkey""", ("utxo",)),
    "daily_tx": ("""
        SELECT Date, avg(fee_usd) AS cost_per_tx, avg(output_total_usd) AS atv, count(*) AS tx_count,
               sum(output_total) AS tv_btc, sum(output_total_usd) AS tv_usd
        FROM transactions GROUP BY Date""", ("transactions",)),
    "daily_cdd": ("SELECT spent AS Date, sum(cdd) AS cdd FROM inputs GROUP BY spent", ("inputs",)),
    "daily_out": ("""
        SELECT created AS Date, max(value_usd) AS difficulty,
               sum(value_usd) / nullif(sum(value_btc), 0) AS price,
               sum(sum(value_btc)) OVER (ORDER BY created) AS circulating_supply
        FROM utxo GROUP BY created""", ("utxo",)),
    "basic": ("""
        SELECT Date, cost_per_tx, atv, cdd, circulating_supply, difficulty, price, tx_count, tv_btc, tv_usd
        FROM daily_tx JOIN daily_cdd USING (Date) JOIN daily_out USING (Date)""",
              ("daily_tx", "daily_cdd", "daily_out")),
    "sopr": ("""
        SELECT spent AS Date, sum(spending_value_usd) / nullif(sum(value_usd), 0) AS sopr
        FROM inputs GROUP BY spent""", ("inputs",)),
    "deltas": ("""
        SELECT created AS Date, value_usd AS u, value_btc AS b FROM utxo
        UNION ALL
        SELECT CAST(spent + INTERVAL 1 DAY AS DATE), -value_usd, -value_btc FROM utxo WHERE spent IS NOT NULL""",
               ("utxo",)),
    "realised_cap": ("""
        SELECT Date, sum(sum(u)) OVER (ORDER BY Date) AS rc_usd, sum(sum(b)) OVER (ORDER BY Date) AS rc_btc
        FROM deltas GROUP BY Date""", ("deltas",)),
    "metrics_day": ("""
        SELECT b.*, r.rc_usd, r.rc_btc, s.sopr,
               sum(b.cost_per_tx * b.tx_count) OVER (ORDER BY b.Date) AS thermocap,
               sum(b.cdd * b.price) OVER (ORDER BY b.Date) AS cum_cdd_usd,
               date_diff('day', DATE '1995-01-01', b.Date) + 1 AS n_days,
               b.price * b.circulating_supply AS market_cap
        FROM basic b JOIN realised_cap r USING (Date) JOIN sopr s USING (Date)""",
                    ("basic", "realised_cap", "sopr")),
    "computed": ("""
        SELECT Date, market_cap, rc_usd AS realised_cap,
               rc_usd / nullif(circulating_supply, 0) AS realised_price,
               market_cap / nullif(tv_usd, 0) AS nvt, sopr, thermocap,
               market_cap / nullif(rc_usd, 0) AS mvrv,
               (market_cap - rc_usd) / nullif(market_cap, 0) AS nupl,
               price * rc_btc - rc_usd AS relative_unrealised_profit,
               1.0 / nullif(market_cap / nullif(tv_usd, 0), 0) AS velocity,
               (1.0 - 1.0 / nullif(sopr, 0)) * tv_usd AS net_realised_profit_loss,
               cdd / nullif(tv_btc, 0) AS coin_dormancy,
               market_cap / nullif(thermocap, 0) AS mc_thermocap_ratio,
               cum_cdd_usd / nullif(n_days * circulating_supply, 0) AS transferred_price,
               rc_usd / nullif(circulating_supply, 0)
                 - cum_cdd_usd / nullif(n_days * circulating_supply, 0) AS balanced_price,
               rc_usd - thermocap AS investor_cap
        FROM metrics_day""", ("metrics_day",)),
    "abuse_reports": ("SELECT user_id AS account, ts, props FROM events WHERE event_type = 'error'", ()),
    "category_feed": ("SELECT c_custkey AS account, CAST(c_nationkey % 13 AS INTEGER) AS label FROM customer", ()),
}


def with_views(sql: str, *names: str, extra: dict | None = None) -> str:
    """Prefix ``sql`` with the WITH clauses for ``names`` and their dependencies.

    ``extra`` adds query-local views (name -> (body, deps)) after the shared ones.
    """
    catalog = dict(VIEWS)
    catalog.update(extra or {})
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in catalog[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({catalog[n][0]})" for n in order)
    return f"WITH {ctes}\n{sql}"
