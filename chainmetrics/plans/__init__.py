"""Registered queries and their SQL oracles.

Importing this package registers every query module.
"""

from chainmetrics.plans import (  # noqa: F401
    forest_queries,
    label_queries,
    metric_queries,
    model_queries,
    scan_queries,
    stream_queries,
    serving_queries,
    stats_queries,
    tree_queries,
)
from chainmetrics.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
