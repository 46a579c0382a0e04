"""Accounts seen so far, in hash buckets with bit filters, for streams that add new ones only (K2).

A batch need not read what earlier batches stored: every account belongs to one bucket
and one filter page of it, and sets three bits of that page (a blocked Bloom filter). An
account whose bits aren't all set is new. Only the buckets of the others are opened, as
partitions of the table, and only these accounts are joined with what they hold.

Pages are Spark's bitmaps (32,768 bits, 4 KB), built and merged by its bitmap aggregates;
a table has ``buckets`` x ``pages`` of them, whatever it holds. Full pages cost time only:
more buckets are opened, no account is lost or stored twice. Accounts, pages and the list
of opened buckets are stored under the batch's id, and a batch reads what has a smaller
id, so a replay replaces its own rows.

Defined results: a null account is one more account; repeated rows count once; an empty
batch stores nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from chainmetrics.session import materialize, path_exists, scratch_path
from chainmetrics.streaming.jobs import BATCH, _run, create_table, read_table, write_batch

BUCKETS = 64
PAGES = 4
PAGE_BITS = 32768  # fixed value: the size of Spark's bitmaps
BITS = ("bit0", "bit1", "bit2")
PAGE_SCHEMA = StructType([StructField("bucket", IntegerType()), StructField("page", IntegerType()), StructField("bits", BinaryType())])
OPENED_SCHEMA = StructType([StructField("bucket", IntegerType())])


def with_places(keys: DataFrame, key: str, buckets: int = BUCKETS, pages: int = PAGES) -> DataFrame:
    """Append bucket, page and the three bits of every key."""
    def part(seed: int, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(n)).cast("int")

    return keys.withColumns({"bucket": part(1, buckets), "page": part(2, pages),
                             **{b: part(3 + i, PAGE_BITS) for i, b in enumerate(BITS)}})


def filter_pages(placed: DataFrame) -> DataFrame:
    """Filter pages of some keys."""
    return (placed.select("bucket", "page", F.explode(F.array(*BITS)).alias("bit"))
            .groupBy("bucket", "page").agg(F.bitmap_construct_agg(F.col("bit").cast("long")).alias("bits")))


def maybe_stored(placed: DataFrame, pages: DataFrame) -> DataFrame:
    """Append ``maybe``: whether all bits of a key are set in its page."""
    def is_set(bit: str) -> Column:
        byte = F.conv(F.hex(F.substring("bits", (F.floor(F.col(bit) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, F.col(bit) % 8) == 1

    hit = is_set(BITS[0]) & is_set(BITS[1]) & is_set(BITS[2])
    return placed.join(pages, ["bucket", "page"], "left").withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("bits")


def account_schema(key: StructField) -> StructType:
    return StructType([key, StructField("label", IntegerType()), StructField("bucket", IntegerType())])


def read_accounts(spark: SparkSession, path: str, key: StructField) -> DataFrame:
    """All stored accounts: key, label, bucket, batch_id (the last two are folders)."""
    return read_table(spark, f"{path}/accounts", account_schema(key))


def opened_buckets(spark: SparkSession, path: str) -> DataFrame:
    """Which buckets each batch has opened: bucket, batch_id."""
    return read_table(spark, f"{path}/opened", OPENED_SCHEMA)


def add_batch(batch: DataFrame, path: str, batch_id: int, key: str, buckets: int = BUCKETS, pages: int = PAGES) -> None:
    """Store the accounts of a batch that no batch before has stored."""
    spark, field = batch.sparkSession, batch.schema[key]
    earlier = (read_table(spark, f"{path}/pages", PAGE_SCHEMA).where(F.col(BATCH) < batch_id)
               .groupBy("bucket", "page").agg(F.bitmap_or_agg("bits").alias("bits")))
    placed = materialize(maybe_stored(with_places(batch.select(key).distinct(), key, buckets, pages), earlier))
    # At most ``buckets`` numbers.
    opened = sorted(r.bucket for r in placed.where("maybe").select("bucket").distinct().collect())
    stored = read_accounts(spark, path, field).where(F.col("bucket").isin(opened) & (F.col(BATCH) < batch_id)).select(F.col(key).alias("_stored"))
    unsure = placed.where("maybe").join(stored, F.col(key).eqNullSafe(F.col("_stored")), "left_anti")
    fresh = materialize(placed.where("not maybe").unionByName(unsure))
    write_batch(fresh.select(key, F.lit(1).alias("label"), "bucket"), f"{path}/accounts", batch_id, ("bucket",))
    write_batch(filter_pages(fresh), f"{path}/pages", batch_id)
    write_batch(spark.createDataFrame([(b,) for b in opened], OPENED_SCHEMA), f"{path}/opened", batch_id)


def run_membership(spark: SparkSession, stream: DataFrame, path: str | None = None, checkpoint: str | None = None,
                   key: str = "account", buckets: int = BUCKETS, pages: int = PAGES) -> str:
    """Add everything available of a stream, batch by batch; returns the path of the tables."""
    path = path or scratch_path(spark, "members")
    checkpoint = checkpoint or scratch_path(spark, "members-ckpt")
    if not path_exists(spark, f"{path}/accounts"):
        empty = spark.createDataFrame([], account_schema(stream.schema[key]))
        empty.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/accounts/{BATCH}=-1")
        create_table(spark, f"{path}/pages", PAGE_SCHEMA)
        create_table(spark, f"{path}/opened", OPENED_SCHEMA)
    _run(stream, lambda batch, batch_id: add_batch(batch, path, batch_id, key, buckets, pages), checkpoint).awaitTermination()
    return path
