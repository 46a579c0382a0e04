"""Readers for the parquet tables the jobs run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    """Lazy parquet scan. Passing ``columns`` only documents intent: Catalyst
    prunes the scan to the columns the plan uses either way."""
    df = spark.read.parquet(table_path(root, name))
    return df.select(*columns) if columns else df


class Tables:
    """Lazy accessor ``t.lineitem`` -> DataFrame over one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            # One scan definition per table and query (file listing once).
            if name not in self._frames:
                self._frames[name] = read_table(self.spark, self.root, name)
            return self._frames[name]
        raise AttributeError(name)


def stream_path(root: str, name: str) -> str:
    """Path for a file stream over one table.

    A stream source needs a folder or a glob; ``{name}`` is a glob matching
    exactly the table, so a single-file table works as well as a folder.
    """
    return f"{root.rstrip('/')}/{{{name}}}.parquet"
