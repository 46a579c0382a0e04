import datetime as dt
import gzip
import os

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from chainmetrics.operators import incremental as INC
from chainmetrics.session import local_path, scratch_path
from chainmetrics.sources import dumps as DU
from chainmetrics.sources.tables import stream_path
from chainmetrics.streaming import jobs as J

D = dt.date


def test_read_dumps_gz_and_day_filter(spark):
    root = local_path(scratch_path(spark, "raw"))
    os.makedirs(f"{root}/inputs")
    for day, n in (("20200101", 2), ("20200102", 3), ("20200103", 1)):
        with gzip.open(f"{root}/inputs/dump_inputs_{day}.tsv.gz", "wt") as f:
            f.write("hash\tvalue\n" + "".join(f"h{i}\t{i}\n" for i in range(n)))
    df = DU.read_dumps(spark, root, "inputs", "2020-01-02", "2020-01-03", schema="hash STRING, value BIGINT")
    got = rows(df.groupBy("date").count())
    assert got == [(D(2020, 1, 2), 3), (D(2020, 1, 3), 1)]


def test_tsv_to_parquet_infers_and_keeps_bad_rows(spark):
    root = local_path(scratch_path(spark, "tsv"))
    os.makedirs(root)
    bad = ["2\t3.5\textra\tmore", "3"]
    with open(f"{root}/x_outputs_20200105.tsv", "w") as f:
        f.write("a\tb\n1\t2.5\n" + "\n".join(bad) + "\n4\t4.5\n")
    dst = scratch_path(spark, "pq")
    out = DU.tsv_to_parquet(spark, root, dst)
    assert dict(out.dtypes)["a"] == "int" and dict(out.dtypes)["b"] == "double"
    assert rows(out, "date", "a", "b") == [(D(2020, 1, 5), 1, 2.5), (D(2020, 1, 5), 4, 4.5)]
    kept = spark.read.parquet(f"{dst}_rejected")
    assert rows(kept, "line") == sorted((b,) for b in bad)
    assert kept.where("_file like '%x_outputs_20200105.tsv'").count() == 2
    # A declared schema needs one read and rejects values of another type.
    typed = DU.tsv_to_parquet(spark, root, scratch_path(spark, "pq"), schema="a INT, b INT", rejected=scratch_path(spark, "rej"))
    assert typed.count() == 0


def test_tsv_to_parquet_parses_fitting_lines_once(spark, monkeypatch):
    """Lines that fit go straight to the table, without a staged copy; bad ones, of any column, are all kept."""
    staged = []
    monkeypatch.setattr(DU, "scratch_path", lambda s, name: staged.append(name) or scratch_path(s, name))
    for lines, bad in ((["1\t2020-01-01\t2.5", "2\t\t3"], []), (["1\t2020-01-01\t2.5", "x\t2020-01-01\t2", "3\t2020-01-01\tx", "4\tx\t1", "5"], [1, 2, 3, 4])):
        staged.clear()
        root, dst = local_path(scratch_path(spark, "tsv")), scratch_path(spark, "pq")
        for day in ("20200105", "20200106"):
            os.makedirs(f"{root}/day={day}")
            with open(f"{root}/day={day}/part.tsv", "w") as f:
                f.write("a\tb\tc\n" + "\n".join(lines) + "\n")
        out = DU.tsv_to_parquet(spark, root, dst, schema="a INT, b DATE, c DOUBLE")
        kept = spark.read.parquet(f"{dst}_rejected")
        assert out.count() == 2 * (len(lines) - len(bad)) and [n for n, _ in kept.dtypes] == ["_file", "line", "date"]
        assert rows(kept, "date", "line") == sorted((D(2020, 1, d), lines[i]) for d in (5, 6) for i in bad)
        assert len(staged) == (1 if bad else 0)
        # Nothing fits, then nothing at all: the days already there stay.
        for schema, left in (("a DATE, b INT, c DATE", len(lines)), ("a INT, b DATE, c DOUBLE", 0)):
            if not left:
                for day in ("20200105", "20200106"):
                    with open(f"{root}/day={day}/part.tsv", "w") as f:
                        f.write("a\tb\tc\n")
            DU.tsv_to_parquet(spark, root, dst, schema=schema)
            assert spark.read.parquet(f"{dst}_rejected").count() == 2 * left
            assert spark.read.parquet(dst).count() == 2 * (len(lines) - len(bad))


def test_load_tables_for_a_range(spark):
    root, dst = local_path(scratch_path(spark, "raw")), scratch_path(spark, "loaded")
    for table in ("inputs", "outputs"):
        os.makedirs(f"{root}/{table}")
        for day in ("20200101", "20200102", "20200103"):
            with open(f"{root}/{table}/d_{table}_{day}.tsv", "w") as f:
                f.write(f"v\n{day[-1]}\n")
    schemas = {"inputs": "v INT", "outputs": "v INT"}
    DU.load_tables(spark, root, dst, schemas, "2020-01-01", "2020-01-02")
    got = DU.load_tables(spark, root, dst, schemas, "2020-01-02", "2020-01-03")
    for table in schemas:
        assert rows(got[table], "date", "v") == [(D(2020, 1, d), d) for d in (1, 2, 3)]


def test_publish_range_sorted_and_idempotent(spark):
    path = scratch_path(spark, "publish")
    table = spark.createDataFrame([(D(2020, 1 + i // 28, 1 + i % 28), float(i)) for i in range(80)], "Date DATE, x DOUBLE")
    DU.publish_range(table, path, "2020-01-01", "2020-02-10")
    DU.publish_range(table.where("x >= 0").withColumn("x", F.col("x") + 0), path, "2020-02-05", "2020-03-20")
    out = spark.read.parquet(path)
    assert rows(out, "Date", "x") == sorted(rows(table.where("Date <= '2020-03-20'"), "Date", "x"))
    part = [r.Date for r in spark.read.parquet(f"{path}/year=2020").collect()]
    assert part == sorted(part)


def test_day_partitions_idempotent(spark):
    path = scratch_path(spark, "days")
    df = spark.createDataFrame([(D(2020, 1, 1), 1), (D(2020, 1, 2), 2)], "date DATE, v INT")
    DU.write_day_partitions(df, path)
    DU.write_day_partitions(df.where("v = 2"), path)  # reload one day
    assert rows(spark.read.parquet(path), "date", "v") == [(D(2020, 1, 1), 1), (D(2020, 1, 2), 2)]
    INC.upsert_day_partitions(spark, spark.createDataFrame([(D(2020, 1, 2), 7)], "date DATE, v INT"), path)
    assert rows(spark.read.parquet(path), "date", "v") == [(D(2020, 1, 1), 1), (D(2020, 1, 2), 7)]


def test_upsert_twice_equals_once(spark):
    old = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 1, 2), 2.0)], "Date DATE, x DOUBLE")
    new = spark.createDataFrame([(D(2020, 1, 2), 5.0), (D(2020, 1, 3), 6.0)], "Date DATE, x DOUBLE")
    once = INC.upsert_daily(old, new)
    twice = INC.upsert_daily(once, new)
    assert rows(once) == rows(twice) == [(D(2020, 1, 1), 1.0), (D(2020, 1, 2), 5.0), (D(2020, 1, 3), 6.0)]


def test_stream_rollup_equals_batch(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    batch = (events.groupBy(F.col("ts").cast("date").alias("day"), "event_type")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))
    path = J.run_rollup_to_table(spark, J.file_stream(spark, stream_path(SF_SMALL, "events")))
    got = J.read_rollup(spark, path, events.schema)
    key = ("day", "event_type", "n")
    assert rows(got, *key) == rows(batch, *key)
    b = {(r[0], r[1]): r[2] for r in rows(batch, "day", "event_type", "total")}
    for r in rows(got, "day", "event_type", "total"):
        assert r[2] == pytest.approx(b[(r[0], r[1])])


def test_stream_dedupe_and_label_join(spark):
    events = J.file_stream(spark, stream_path(SF_SMALL, "events"))
    reports = events.where("event_type = 'error'").select(F.col("user_id").alias("account"), "ts")
    path = J.run_dedupe_to_table(spark, reports)
    stored = spark.read.parquet(path)
    expect = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_type = 'error'") \
        .select("user_id").distinct().count()
    assert stored.count() == expect == stored.select("account").distinct().count()
    labels = spark.createDataFrame([(1, 1)], "account BIGINT, label INT")
    labelled = J.label_stream(events.select(F.col("user_id").alias("account"), "event_id"), labels)
    out, ck = scratch_path(spark, "lab"), scratch_path(spark, "lab-ck")
    q = (labelled.writeStream.format("parquet").option("checkpointLocation", ck)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    res = spark.read.parquet(out)
    assert res.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count() > 0
    assert res.where("label = 1").count() == res.where("account = 1").count()


def test_stream_days_independent_of_session_zone(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    batch = rows(events.groupBy(F.col("ts").cast("date").alias("day"), "event_type").count(),
                 "day", "event_type", "count")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        path = J.run_rollup_to_table(spark, J.file_stream(spark, stream_path(SF_SMALL, "events")))
        got = rows(J.read_rollup(spark, path, events.schema), "day", "event_type", "n")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == batch


def test_hot_day_written_by_several_tasks(spark):
    """Default settings but for the advisory size: a day beyond it has several writers, a small day one file."""
    import glob
    path = scratch_path(spark, "hotday")
    hot = spark.range(200_000).select(F.lit(D(2020, 1, 1)).alias("date"), F.xxhash64("id").alias("v"))
    cold = spark.range(100).select(F.lit(D(2020, 1, 2)).alias("date"), F.col("id").alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        DU.write_day_partitions(hot.unionByName(cold).repartition(6), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(glob.glob(f"{local_path(path)}/date=2020-01-01/*.parquet")) > 1
    assert len(glob.glob(f"{local_path(path)}/date=2020-01-02/*.parquet")) == 1
    assert spark.read.parquet(path).where("date = '2020-01-01'").count() == 200_000


def test_rollup_sums_batches_and_replays(spark):
    """Two batches touching the same day are summed; a replayed batch replaces its own rows."""
    path = scratch_path(spark, "merge")
    schema = spark.createDataFrame([], "event_type STRING").schema
    table = "day DATE, event_type STRING, n BIGINT, total DOUBLE"
    J.write_batch(spark.createDataFrame([(D(2024, 1, 1), "a", 1, 1.0), (D(2024, 1, 2), "a", 5, 5.0)], table), path, 0)
    for _ in range(2):
        J.write_batch(spark.createDataFrame([(D(2024, 1, 1), "a", 3, 4.0), (D(2024, 1, 1), "b", 2, 2.0)], table), path, 1)
    got = rows(J.read_rollup(spark, path, schema), "day", "event_type", "n", "total")
    assert got == [(D(2024, 1, 1), "a", 4, 5.0), (D(2024, 1, 1), "b", 2, 2.0), (D(2024, 1, 2), "a", 5, 5.0)]


def test_landing_replace_and_exists(spark):
    from chainmetrics.session import table_exists
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").where("event_type = 'error'") \
        .select(F.col("user_id").cast("string").alias("address"), F.col("ts").cast("date").alias("date"))
    land = scratch_path(spark, "landing")
    assert not table_exists(spark, land)
    DU.write_landing(events, land, fmt="json")
    assert table_exists(spark, land)
    back = spark.read.json(land)
    assert back.count() == events.count() and set(back.columns) == {"address", "date"}
    csv_land = scratch_path(spark, "landing-csv")
    DU.write_landing(events, csv_land, fmt="csv")
    reports = DU.read_report_csv(spark, csv_land)
    assert reports.count() == events.count()
    out = scratch_path(spark, "replace")
    DU.replace_table(events, out)
    DU.replace_table(events.limit(3), out)
    assert spark.read.parquet(out).count() == 3


def _event_files(spark, order):
    """The small events table as four files in ``order`` of time, one per micro-batch."""
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = scratch_path(spark, "events-files")
    key = {"newest": F.desc("ts"), "shuffled": F.xxhash64("event_id")}[order]
    events.repartitionByRange(4, key).write.parquet(src)
    return events, J.file_stream(spark, src, like=events, max_files=1)


@pytest.mark.parametrize("order", ["newest", "shuffled"])
def test_out_of_order_files_equal_batch(spark, order):
    """Default settings, several micro-batches, rows days late: counts and totals equal one batch."""
    events, stream = _event_files(spark, order)
    path, ckpt = scratch_path(spark, "mb-rollup"), scratch_path(spark, "mb-ckpt")
    for _ in range(2):  # the second run finds nothing new
        J.run_rollup_to_table(spark, stream, path, ckpt)
    assert spark.read.parquet(path).select("batch_id").distinct().count() == 4
    batch = events.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    got = J.read_rollup(spark, path, events.schema)
    assert rows(got, "day", "event_type", "n") == rows(batch, "day", "event_type", "n")
    assert [r[2] for r in rows(got, "day", "event_type", "total")] == pytest.approx([r[2] for r in rows(batch, "day", "event_type", "total")])

    reports = stream.where("event_type = 'error'").select(F.col("user_id").alias("account"), "ts")
    stored = spark.read.parquet(J.run_dedupe_to_table(spark, reports))
    want = events.where("event_type = 'error'").select("user_id").distinct().count()
    assert stored.count() == want == stored.select("account").distinct().count()


def test_failed_first_batch_is_replayed(spark):
    """A first write that fails half way leaves a folder behind; the replay stores the batch once."""
    events, stream = _event_files(spark, "newest")
    path, ckpt = scratch_path(spark, "fail"), scratch_path(spark, "fail-ckpt")
    write, calls = J.write_batch, []

    def failing(rows_, target, batch_id, partition_by=()):
        calls.append(batch_id)
        write(rows_.limit(1) if len(calls) == 1 else rows_, target, batch_id, partition_by)
        if len(calls) == 1:
            raise OSError("lost while writing")

    J.write_batch = failing
    try:
        with pytest.raises(Exception):
            J.run_rollup_to_table(spark, stream, path, ckpt)
        J.run_rollup_to_table(spark, stream, path, ckpt)
    finally:
        J.write_batch = write
    assert calls[:2] == [0, 0]
    assert J.read_rollup(spark, path, events.schema).agg(F.sum("n")).first()[0] == events.count()


def test_replayed_dedupe_batch_keeps_its_accounts(spark):
    path = scratch_path(spark, "dedupe")
    seen = []
    J_run = J._run

    def twice(stream, write, checkpoint):
        return J_run(stream, lambda b, i: (write(b, i), write(b, i), seen.append(i)), checkpoint)

    _, stream = _event_files(spark, "shuffled")
    J._run = twice
    try:
        J.run_dedupe_to_table(spark, stream.select(F.col("user_id").alias("account")), path)
    finally:
        J._run = J_run
    want = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("user_id").distinct().count()
    assert len(seen) == 4 and spark.read.parquet(path).count() == want


def test_empty_stream_gives_an_empty_table(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = local_path(scratch_path(spark, "nothing"))
    os.makedirs(src)
    stream = J.file_stream(spark, src, like=events)
    assert J.read_rollup(spark, J.run_rollup_to_table(spark, stream), events.schema).count() == 0
    assert spark.read.parquet(J.run_dedupe_to_table(spark, stream.select(F.col("user_id").alias("account")))).count() == 0
