"""The day-dump data source: pruning, types, streaming by days."""

import datetime as dt
import gzip
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from chainmetrics.session import local_path, scratch_path
from chainmetrics.sources import day_source as DS
from chainmetrics.streaming import jobs as J

D = dt.date
SCHEMA = "hash STRING, n BIGINT, v DOUBLE, created DATE"


def put(root, day, lines, table="outputs", packed=True, header="hash\tn\tv\tcreated\textra\n"):
    os.makedirs(f"{root}/{table}", exist_ok=True)
    name = f"{root}/{table}/dump_{table}_{day}.tsv"
    with (gzip.open(name + ".gz", "wt") if packed else open(name, "w")) as f:
        f.write(header + "".join("\t".join(map(str, x)) + "\n" for x in lines))


@pytest.fixture
def root(spark):
    path = local_path(scratch_path(spark, "days"))
    for i in range(1, 10):
        put(path, f"2020010{i}", [(f"h{j}", j, j / 2, f"2020-01-0{i}", "x") for j in range(i)], packed=i % 2 == 0)
    return path


def test_days_types_and_missing_columns(spark, root):
    df = DS.read_days(spark, root, "outputs", SCHEMA + ", other INT")
    assert rows(df.groupBy("date").count()) == [(D(2020, 1, i), i) for i in range(1, 10)]
    assert df.where("date = created and v = n / 2 and other is null").count() == 45
    assert df.rdd.getNumPartitions() == 9  # one per day file
    assert DS.read_days(spark, root, "nothing", SCHEMA).count() == 0


def test_other_days_are_not_opened(spark, root):
    """Files outside of the filter are garbage, and nobody notices."""
    for i in (1, 2, 8, 9):
        for end in ("", ".gz"):
            name = f"{root}/outputs/dump_outputs_2020010{i}.tsv{end}"
            if os.path.exists(name):
                with open(name, "wb") as f:
                    f.write(b"hash\tn\nnot\ta\tdump\n")
    day = F.col("date")
    for kept, n in ((day.between("2020-01-03", "2020-01-05"), 3), ((day > D(2020, 1, 2)) & (day < D(2020, 1, 8)) & (F.col("n") >= 0), 5),
                    (day == D(2020, 1, 4), 1), (day.isin(D(2020, 1, 3), D(2020, 1, 5)), 3)):
        some = DS.read_days(spark, root, "outputs", SCHEMA, pushdown=True).where(kept)
        assert some.rdd.getNumPartitions() == n
    some = DS.read_days(spark, root, "outputs", SCHEMA, pushdown=True).where(day.isin(D(2020, 1, 3), D(2020, 1, 5)))
    assert rows(some.groupBy("date").count()) == [(D(2020, 1, 3), 3), (D(2020, 1, 5), 5)]
    assert DS.read_days(spark, root, "outputs", SCHEMA, "2020-01-06", "2020-01-07").count() == 13
    with pytest.raises(Exception, match="dump_outputs_2020010"):
        DS.read_days(spark, root, "outputs", SCHEMA).count()


def test_a_frame_may_be_filtered_twice(spark, root):
    df = DS.read_days(spark, root, "outputs", SCHEMA)
    one, two = df.where("date = DATE '2020-01-02'"), df.where("date = DATE '2020-01-05'")
    assert (one.count(), two.count(), df.count(), one.unionByName(two).count()) == (2, 5, 45, 7)


def test_stream_goes_on_with_the_next_day(spark, root):
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")

    def run():
        stream = DS.stream_days(spark, root, "outputs", SCHEMA, start="2020-01-02")
        J.append_stream(stream, out, ckpt, ("date",)).awaitTermination()
        return rows(spark.read.parquet(out).groupBy("batch_id", "date").count().where("count > 0"))

    assert run() == [(0, D(2020, 1, i), i) for i in range(2, 10)]
    assert run() == [(0, D(2020, 1, i), i) for i in range(2, 10)]
    put(root, "20200110", [("a", 1, 1.0, "2020-01-10", "")])
    put(root, "20200112", [("b", 1, 1.0, "2020-01-12", "")] * 2)
    assert run()[8:] == [(1, D(2020, 1, 10), 1), (1, D(2020, 1, 12), 2)]


def test_a_schema_is_needed(spark, root):
    DS.register(spark)
    with pytest.raises(Exception, match="schema"):
        spark.read.format("day_dumps").option("path", root).load()
