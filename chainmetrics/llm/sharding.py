"""Weighted rendezvous sharding of records, with DataFrame functions only.

Every record key is hashed with every shard; the shard with the smallest
``-ln(u) / weight`` wins. A record's shard depends on its key and the shard
weights alone, so one more shard takes over only the records it wins, and a
shard holds a share of the keys proportional to its weight.

``place`` is row-local. ``assign`` adds a gapless slot per shard without bringing
a shard together: rows are numbered inside (shard, input split), and the split
sizes, a table of shards x splits rows, give each split its first slot. Only the
narrow columns are shuffled, never the texts. The narrow table is checkpointed
once, so that a lost executor can't change which split a row was counted in.

Defined results: a null key is one more key; rows of the same key share a shard
and have different slots; null text has no bytes (size 8, crc32 0); an empty table
gives an empty table; other input columns are kept by ``place`` and left out by
``assign``, and ``place`` replaces a column named like its output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainmetrics.session import materialize


def _score(key: Column, shard: int, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / F.lit(2.0**53)
    return -F.log(u) / F.lit(float(weight))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Index of the winning shard (ties, practically impossible, to the smaller index)."""
    if not weights or min(weights) <= 0:
        raise ValueError("at least one shard, and positive weights")
    scores = [F.struct(_score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]
    return F.array_min(F.array(*scores))["shard"]


def place(df: DataFrame, weights: Sequence[float], key: str = "doc_id", shard_col: str = "shard") -> DataFrame:
    """Append the shard of every row; row-local."""
    return df.withColumn(shard_col, shard_of(F.col(key), weights))


def assign(df: DataFrame, weights: Sequence[float], key: str = "doc_id", text_col: str = "text",
           grown_weight: float | None = None) -> DataFrame:
    """One row per input row: key, size (UTF-8 bytes + 8), text_crc32, shard, slot
    (0, 1, ... in each shard) and grown_shard, the shard if one more, of
    ``grown_weight`` (default: the last weight), were there."""
    grown = [*weights, weights[-1] if grown_weight is None else grown_weight]
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = materialize(df.select(
        F.col(key),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), grown).alias("grown_shard"),
        F.spark_partition_id().alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
    ))
    before = Window.partitionBy("shard").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    first = (narrow.groupBy("shard", "_split").agg(F.count(F.lit(1)).alias("_n"))
             .select("shard", "_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    within = Window.partitionBy("shard", "_split").orderBy("_row")
    return (narrow.join(first, ["shard", "_split"])
            .select(key, "size", "text_crc32", "shard",
                    (F.col("_first") + F.row_number().over(within) - 1).cast("long").alias("slot"), "grown_shard"))
