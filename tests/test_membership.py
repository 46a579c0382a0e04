"""Accounts in hash buckets with bit filters: which buckets a batch opens, restarts, replays."""

from pyspark.sql import functions as F

from chainmetrics.session import scratch_path
from chainmetrics.streaming import jobs as J
from chainmetrics.streaming import membership as MB


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "account long")


def stored(spark, path):
    field = ids(spark, 1).schema["account"]
    return sorted(((r.account, r.batch_id) for r in MB.read_accounts(spark, path, field).collect()), key=str)


def feed(spark, src, path, ckpt, **sizes):
    return MB.run_membership(spark, J.file_stream(spark, src, ids(spark, 1), max_files=1), path, ckpt, **sizes)


def test_batches_open_only_buckets_of_known_accounts(spark):
    src, path, ckpt = (scratch_path(spark, n) for n in ("feed", "members", "ckpt"))
    ids(spark, *range(100), 5, None, None).coalesce(1).write.mode("append").parquet(src)
    feed(spark, src, path, ckpt)
    assert MB.opened_buckets(spark, path).count() == 0
    # A restart with a batch of new accounts, three known ones and the null account again.
    ids(spark, *range(1000, 1050), 7, 8, 9, None).coalesce(1).write.mode("append").parquet(src)
    feed(spark, src, path, ckpt)
    assert [a for a, _ in stored(spark, path)].count(None) == 1
    assert sorted(a for a, _ in stored(spark, path) if a is not None) == [*range(100), *range(1000, 1050)]
    known = {r.bucket for r in MB.with_places(ids(spark, 7, 8, 9, None), "account").collect()}
    opened = {r.bucket for r in MB.opened_buckets(spark, path).collect()}
    # Hardly any other bucket: three bits of 32,768 that some 100 accounts have set.
    assert known <= opened and len(opened) <= len(known) + 1
    read = MB.read_accounts(spark, path, ids(spark, 1).schema["account"]).where(F.col("bucket").isin(list(opened)))
    files = {f.split("bucket=")[1].split("/")[0] for f in read.select(F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert {int(f) for f in files} <= opened


def test_full_filters_and_replays_store_nothing_twice(spark):
    path = scratch_path(spark, "members")
    src, ckpt = scratch_path(spark, "feed"), scratch_path(spark, "ckpt")
    ids(spark, *range(3000)).coalesce(1).write.mode("append").parquet(src)
    feed(spark, src, path, ckpt, buckets=2, pages=1)
    batch = ids(spark, *range(2990, 3020), *range(2990, 3020))
    for _ in range(2):  # the second time it is a replay
        MB.add_batch(batch, path, 1, "account", 2, 1)
        got = stored(spark, path)
        assert len(got) == 3020 and {a for a, b in got if b == 1} == set(range(3000, 3020))
    MB.add_batch(ids(spark), path, 2, "account", 2, 1)
    assert len(stored(spark, path)) == 3020


def test_bits_of_stored_accounts_are_set(spark):
    placed = MB.with_places(spark.range(5000).withColumnRenamed("id", "account"), "account")
    got = MB.maybe_stored(MB.with_places(spark.range(50_000).withColumnRenamed("id", "account"), "account"), MB.filter_pages(placed))
    share = {r.old: r.share for r in got.groupBy((F.col("account") < 5000).alias("old")).agg(F.avg(F.col("maybe").cast("int")).alias("share")).collect()}
    assert share[True] == 1.0 and share[False] < 0.001
