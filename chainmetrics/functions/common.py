"""Small column and schema helpers (casts, day keys, feature lists)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_day(col, formats=("dd/MM/yyyy", "yyyy-MM-dd")) -> Column:
    """Text -> DATE trying day-first first, then ISO; NULL when nothing fits."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def day_key(col) -> Column:
    """DATE -> 'YYYYMMDD' text, the day key of file names."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyyMMdd")


def name_part(col, sep: str = "_", index: int = 1) -> Column:
    """The ``index``-th (0-based) piece of ``col`` split by ``sep``; NULL if absent."""
    c = F.col(col) if isinstance(col, str) else col
    return F.get(F.split(c, sep, -1), index)


def flag_to_int(col) -> Column:
    """BOOLEAN flag -> 0/1."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("int")


def feature_columns(df: DataFrame, non_features=("Date", "index", "anomaly", "score")) -> list[str]:
    """Every column that is not bookkeeping, sorted (B23). Plan-time only."""
    return sorted(set(df.columns) - set(non_features))
