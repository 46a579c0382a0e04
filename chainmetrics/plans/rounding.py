"""Output rounding for the registered queries and their SQL oracles.

Sums taken in a different order differ in the last bits, and many USD amounts
here end exactly on half a cent, where two engines may round a tie apart. The
registered queries therefore round on both sides the same way: USD amounts to
cents after a small offset that moves values off exact half-cent ties, ratios
to 6 places, and differences of two large sums to whole units. The operators
themselves never round.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (places, offset). Amounts here sit on a 4-decimal grid (2-decimal prices x
# 2-decimal rates), so each offset puts the rounding tie between grid points:
# cents tie at .004863, whole units at .48625, ratios at a 10th decimal.
USD = (2, 0.000137)
RATIO = (6, 0.0000000137)
WHOLE = (0, 0.01375)
# Running sums beyond ~1e12 carry float noise near 1e-3: compare in thousands.
THOUSANDS = (-3, 13.75)


def rnd(col, spec=RATIO) -> Column:
    """Rounded value; ``+ 0.0`` turns a negative zero into 0.0 (engines differ there)."""
    places, offset = spec
    c = F.col(col) if isinstance(col, str) else col
    r = F.round(c + F.lit(offset), places) if offset else F.round(c, places)
    return r + F.lit(0.0)


def sql_rnd(expr: str, spec=RATIO) -> str:
    places, offset = spec
    r = f"round(({expr}) + {offset!r}, {places})" if offset else f"round({expr}, {places})"
    return f"({r} + 0.0)"


def round_all(df, specs: dict):
    """Round the named columns in place, keeping column order."""
    return df.select(*[rnd(c, specs[c]).alias(c) if c in specs else F.col(c) for c in df.columns])


def sql_select(specs: dict, columns, source: str = "") -> str:
    """``SELECT`` list text rounding ``columns`` by ``specs``."""
    parts = []
    for c in columns:
        parts.append(f"{sql_rnd(source + c, specs[c])} AS {c}" if c in specs else f"{source}{c} AS {c}")
    return ", ".join(parts)
