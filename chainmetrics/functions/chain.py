"""Column expressions for the valuation metrics.

Each function takes Columns (or names) and returns a Column, so they compose
inside one projection and stay inside whole-stage codegen. Division is
``try_divide``: a zero or null divisor gives NULL instead of an error (ANSI).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First day of the chain used for the day count (B11) and the
# coin unit of the upstream integer amounts.
CHAIN_GENESIS = "2009-01-03"
SATOSHI_PER_COIN = 100_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    return F.try_divide(_c(num), _c(den))


def to_coins(amount) -> Column:
    """Integer base units -> coins."""
    return _c(amount) / F.lit(float(SATOSHI_PER_COIN))


def market_cap(price="price", supply="circulating_supply") -> Column:
    return _c(price) * _c(supply)


def nvt(mc="market_cap", tv_usd="tv_usd") -> Column:
    return safe_div(mc, tv_usd)


def velocity(nvt_col="nvt") -> Column:
    return safe_div(F.lit(1.0), nvt_col)


def net_realised_profit_loss(sopr="sopr", tv_usd="tv_usd") -> Column:
    return (F.lit(1.0) - safe_div(F.lit(1.0), sopr)) * _c(tv_usd)


def coin_dormancy(cdd="cdd", tv_btc="tv_btc") -> Column:
    return safe_div(cdd, tv_btc)


def realised_price(rc_usd="rc_usd", supply="circulating_supply") -> Column:
    return safe_div(rc_usd, supply)


def mvrv(mc="market_cap", rc_usd="rc_usd") -> Column:
    return safe_div(mc, rc_usd)


def nupl(mc="market_cap", rc_usd="rc_usd") -> Column:
    return safe_div(_c(mc) - _c(rc_usd), mc)


def relative_unrealised_profit(price="price", rc_btc="rc_btc", rc_usd="rc_usd") -> Column:
    # As computed upstream: price x realised coins - realised USD (no division
    # by market cap, although the catalogue text mentions one).
    return _c(price) * _c(rc_btc) - _c(rc_usd)


def thermocap_ratio(mc="market_cap", thermocap="thermocap") -> Column:
    return safe_div(mc, thermocap)


def investor_cap(rc_usd="rc_usd", thermocap="thermocap") -> Column:
    return _c(rc_usd) - _c(thermocap)


def day_number(date="Date", genesis: str = CHAIN_GENESIS) -> Column:
    """Days since genesis, genesis itself being day 1."""
    return F.datediff(_c(date), F.lit(genesis).cast("date")) + 1


def transferred_price(cum_cdd_usd="cum_cdd_usd", days="n_days",
                      supply="circulating_supply") -> Column:
    return safe_div(cum_cdd_usd, _c(days) * _c(supply))


def balanced_price(realised_price_col="realised_price", transferred="transferred_price") -> Column:
    return _c(realised_price_col) - _c(transferred)
