"""Arriving rows wait in Spark's state store for their partner (K3).

Both feeds are streams. ``run_pairing`` joins them with a watermarked outer stream-stream join:
a row is kept in keyed state until its partner comes, for at most ``wait``; then its
timer (the watermark) passes and it leaves the state for the late table. A partner is
remembered for ``keep``. A batch touches the state of the keys it brings, never a whole
table; state and offsets are in the checkpoint, so a restarted run goes on where it stopped.

Nothing is lost: time is the time of arrival, the batch's clock by default, so a row is never
older than the watermark, whatever order files or days come in. A feed may bring its own
clock; it must run forward over both feeds, and a run fails if the store had to drop a
row. Both feeds move the watermark (the later one counts), so rows expire while one
feed is silent; a partner with a null key is a mere tick.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainmetrics.session import path_exists
from chainmetrics.streaming.jobs import BATCH, write_batch

LATE = "late"
#: Waiting rows are kept on disk (RocksDB), one store for each partition, and a batch stores its
#: changes only: rows in the heap would be loaded whole by every restart.
STATE = {"spark.sql.streaming.multipleWatermarkPolicy": "max",
         "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
         "spark.sql.streaming.join.stateFormatVersion": "3"}


def pair_streams(rows: DataFrame, partners: DataFrame, on: str, right_on: str, wait: str, keep: str | None = None,
                 clock: Column | None = None) -> DataFrame:
    """Every row with its partner's columns, and ``late`` where none came within ``wait``.

    Rows and partners repeat as they come (as in a batch join); rows with a null key are late.
    ``clock`` is an expression over either feed; its columns are given up."""
    shared = set(rows.columns) & set(partners.columns)
    used = {c for c in shared if clock is not None and c in str(clock)}
    if shared - used or LATE in rows.columns + partners.columns:
        raise ValueError(f"columns of both feeds: {sorted(shared - used)}")
    clock = F.current_timestamp() if clock is None else clock
    left = rows.withColumn("_arrived", clock).drop(*used).withWatermark("_arrived", "0 seconds")
    right = partners.withColumn("_came", clock).drop(*used).withWatermark("_came", "0 seconds")

    # Keys as structs: a null partner key meets nothing, but its row still moves the watermark
    # (a filter on plain keys would take it away before).
    def key(column, is_null):
        return F.struct(F.col(column).alias("key"), is_null.alias("is_null"))

    same = key(on, F.col(on).isNull()) == key(right_on, F.lit(False))
    within = (same & (F.col("_came") <= F.col("_arrived") + F.expr(f"INTERVAL {wait}"))
              & (F.col("_arrived") <= F.col("_came") + F.expr(f"INTERVAL {keep or wait}")))
    return left.join(right, within, "left").withColumn(LATE, F.col("_came").isNull()).drop("_arrived", "_came")


def run_pairing(rows: DataFrame, partners: DataFrame, on: str, right_on: str, path: str, checkpoint: str, wait: str,
                keep: str | None = None, clock: Column | None = None, build: Callable[[DataFrame], DataFrame] = lambda df: df,
                partition_by=(LATE,)) -> list[dict]:
    """Pair everything available and append ``build(pairs)`` (which keeps ``late``) below ``path``.

    One write per batch, replaced when a batch is replayed. Returns batch, state_rows and
    dropped of every batch of this run."""
    spark = rows.sparkSession
    out = build(pair_streams(rows, partners, on, right_on, wait, keep, clock))
    if not path_exists(spark, path):
        spark.createDataFrame([], out.schema).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{BATCH}=-1")
    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        query = (out.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id, partition_by))
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    query.awaitTermination()
    seen = [{"batch": p["batchId"], "state_rows": sum(s["numRowsTotal"] for s in p["stateOperators"]),
             "dropped": sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])}
            for p in query.recentProgress if p["stateOperators"]]
    if any(p["dropped"] for p in seen):
        raise RuntimeError(f"the feeds' clock ran backwards, rows were dropped: {seen}")
    return seen


def read_pairs(spark: SparkSession, path: str, late: bool | None = None) -> DataFrame:
    """What was stored: the pairs (late=False), the late table (late=True), or both."""
    df = spark.read.parquet(path).drop(BATCH).withColumn(LATE, F.col(LATE).cast("boolean"))
    return df if late is None else df.where(F.col(LATE) == late).drop(LATE)
