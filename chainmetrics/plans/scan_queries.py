"""Registered queries: running sums and ribbons at transaction grain."""

from __future__ import annotations

from chainmetrics.operators import scans as SC
from chainmetrics.operators.serving import RIBBON_WINDOWS
from chainmetrics.plans.registry import register, with_views
from chainmetrics.plans.rounding import RATIO, USD, round_all, sql_rnd
from chainmetrics.sources import adapters as A

RIBBON = [f"d{w}" for w in RIBBON_WINDOWS]


@register("running_fees", with_views(f"""
    SELECT hash, Date, {sql_rnd('sum(fee_usd) OVER (ORDER BY Date, hash)', USD)} AS fees_so_far,
           {sql_rnd('sum(output_total_usd) OVER (ORDER BY Date, hash)', USD)} AS volume_so_far FROM transactions""", "transactions"))
def q_running_fees(t):
    """Running fee and volume after every single transaction: blocks with totals carried on."""
    tx = A.transactions(t.lineitem, t.orders).select("hash", "Date", "fee_usd", "output_total_usd")
    out = SC.long_running_sums(tx, ("Date", "hash"), {"fees_so_far": "fee_usd", "volume_so_far": "output_total_usd"})
    return round_all(out.select("hash", "Date", "fees_so_far", "volume_so_far"), {"fees_so_far": USD, "volume_so_far": USD})


def _mean_sql(w: int) -> str:
    return (f"CASE WHEN row_number() OVER (ORDER BY Date, hash) >= {w} THEN "
            + sql_rnd(f"avg(output_total_usd) OVER (ORDER BY Date, hash ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)", RATIO) + f" END AS d{w}")


@register("transaction_ribbon", with_views(f"""
    SELECT hash, Date, {', '.join(_mean_sql(w) for w in RIBBON_WINDOWS)} FROM transactions""", "transactions"))
def q_transaction_ribbon(t):
    """Moving means over the last 14 to 200 transactions at every transaction: blocks with halo rows."""
    tx = A.transactions(t.lineitem, t.orders).select("hash", "Date", "output_total_usd")
    out = SC.moving_means(tx, ("Date", "hash"), "output_total_usd", RIBBON_WINDOWS, block_rows=4096)
    return round_all(out.select("hash", "Date", *RIBBON), dict.fromkeys(RIBBON, RATIO))
