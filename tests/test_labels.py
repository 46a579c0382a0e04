import json

from conftest import rows

from chainmetrics.operators import labels as L
from chainmetrics.session import local_path, scratch_path


def test_category_filter(spark):
    feed = spark.createDataFrame([(1, 0), (2, 1), (3, 9), (4, 12), (5, None)], "account BIGINT, label INT")
    assert rows(L.category_labels(feed)) == [(1, 1), (3, 1)]


def test_union_dedupe_audit(spark):
    a = spark.createDataFrame([(1, 1), (2, 1)], "account BIGINT, label INT")
    b = spark.createDataFrame([(2, 1), (3, 1), (3, 1), (3, 1)], "account BIGINT, label INT")
    u = L.label_union({"category": a, "reports": b})
    assert u.count() == 6
    assert rows(L.duplicate_audit(u), "account", "n") == [(2, 2), (3, 3)]
    d = L.dedupe_labels(u)
    assert rows(d) == [(1, 1, "category"), (2, 1, "category"), (3, 1, "reports")]
    assert L.duplicate_audit(d).count() == 0
    assert rows(L.dedupe_labels(d)) == rows(d)  # idempotent


def test_explode_report_pages(spark):
    path = scratch_path(spark, "pages")
    import os
    os.makedirs(local_path(path))
    for i, addrs in enumerate([["a", "b"], ["b", "c", "c"]]):
        with open(f"{local_path(path)}/page_{i}.json", "w") as f:
            json.dump({"data": [{"address": x} for x in addrs]}, f)
    from chainmetrics.sources.dumps import read_report_pages
    pages = read_report_pages(spark, path)
    got = L.explode_report_pages(pages)
    assert rows(got, "account") == [("a",), ("b",), ("b",), ("c",), ("c",)]
    text = spark.createDataFrame([('{"data": [{"address": "x"}]}',)], "data STRING")
    assert rows(L.explode_report_pages(text)) == [("x", 1)]


def test_label_inputs_fill_and_join(spark):
    inputs = spark.createDataFrame([(1, 10, 5.0), (1, 11, 6.0), (2, 12, 7.0), (3, 10, 1.0)],
                                   "hash BIGINT, account BIGINT, value_btc DOUBLE")
    labels = spark.createDataFrame([(10, 1)], "account BIGINT, label INT")
    tx = spark.createDataFrame([(1, 2, 9.0), (2, 1, 8.0)], "hash BIGINT, input_count BIGINT, fee_usd DOUBLE")
    got = L.label_inputs(inputs, labels, tx, ("input_count", "fee_usd"))
    assert rows(got, "hash", "account", "label", "input_count") == [(1, 10, 1, 2), (1, 11, 0, 2), (2, 12, 0, 1)]


def test_fill_missing_types(spark):
    df = spark.createDataFrame([(None, None, None)], "a INT, b STRING, c BOOLEAN")
    r = L.fill_missing(df).first()
    assert (r["a"], r["b"], r["c"]) == (0, None, False)


def test_dedupe_by_rank_hot_account_hash_aggregate(spark):
    from pyspark.sql import functions as F
    hot = spark.range(30000).select(F.lit(7).cast("bigint").alias("account"), F.lit(1).alias("label"))
    rest = spark.range(60000).select((F.col("id") + 100).alias("account"), F.lit(1).alias("label"))
    feeds = {"category": rest, "reports": hot.unionByName(rest.limit(10))}
    out = L.illicit_label_table(feeds)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert out.count() == 60001
    got = {r["account"]: r["source"] for r in out.where("account IN (7, 100, 101)").collect()}
    assert got == {7: "reports", 100: "category", 101: "category"}


def test_hot_account_join_is_split_by_aqe(spark):
    """One account holds a third of the inputs: AQE splits its join partition."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 60000
        # Distinct values per row: AQE judges skew by (compressed) shuffle bytes.
        inputs = spark.range(n).select((F.col("id") % 1000).alias("hash"),
                                       F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("account"),
                                       F.rand(3).alias("value_btc"))
        labels = spark.range(0, n, 2).select(F.col("id").alias("account"), F.lit(1).alias("label"))
        tx = spark.range(1000).select(F.col("id").alias("hash"), F.lit(2).cast("long").alias("input_count"))
        out = L.label_inputs(inputs, labels, tx, ("input_count",))
        got = out.collect()  # runs this Dataset's own adaptive plan
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan, plan
        assert len(got) == n and sum(1 for r in got if r["account"] == 7) == n // 3 + 1  # + id 7 itself
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
