"""Incremental maintenance of day tables: newest-wins upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainmetrics.session import scratch_path
from chainmetrics.sources.dumps import write_day_partitions


def upsert_daily(existing: DataFrame, new: DataFrame, key: str = "Date") -> DataFrame:
    """UNION ALL + newest wins per key.

    Rows of ``new`` replace rows of ``existing`` with the same key, so loading
    a day twice equals loading it once. One hash aggregation keyed by ``key``
    with map-side partial aggregation (a hot key costs one row per map task).
    """
    cols = existing.columns
    tagged = (existing.select(*cols, F.lit(0).alias("_v"))
              .unionByName(new.select(*cols, F.lit(1).alias("_v"))))
    rest = [c for c in cols if c != key]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col("_v")).alias("_row")
    return tagged.groupBy(key).agg(best).select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert_day_partitions(spark: SparkSession, new: DataFrame, path: str, day_col: str = "date") -> None:
    """Replace the day partitions ``new`` touches in the table at ``path`` (A4 + G2).

    The new rows are staged in the shared checkpoint folder first, then written
    with dynamic partition overwrite: days not in ``new`` are untouched, and a
    repeated load of the same days is idempotent.
    """
    staged = scratch_path(spark, "upsert")
    new.write.mode("overwrite").parquet(staged)
    write_day_partitions(spark.read.parquet(staged), path, day_col)
