"""Day files whose types widen between loads."""

import os

import pytest
from pyspark.sql import types as T

from chainmetrics.session import local_path, scratch_path
from chainmetrics.sources import widening as WD

I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize("a, b, out", [(I, L, L), (L, D, D), (D, I, D), (I, S, S), (T.DateType(), T.TimestampType(), T.TimestampType()),
                                       (T.DateType(), I, S), (T.BooleanType(), I, S), (L, T.DecimalType(20, 0), WD.BIG), (D, T.DecimalType(20, 0), S)])
def test_wider(a, b, out):
    assert WD.wider(a, b) == out == WD.wider(b, a)


def load(spark, dst, **days):
    root = local_path(scratch_path(spark, "feed"))
    os.makedirs(root)
    for day, lines in days.items():
        with open(f"{root}/x_t_{day[1:]}.tsv", "w", encoding="utf-8") as f:
            f.write("\n".join("\t".join(line) for line in lines) + "\n")
    return WD.add_load(spark, root, dst)


def test_versions_and_replaced_days(spark):
    dst = scratch_path(spark, "table")
    head = ("id", "v")
    assert load(spark, dst, d20200101=[head, ("1", "7")], d20200102=[head, ("2", "8")]) == 0
    assert load(spark, dst, d20200103=[head, ("3", "")]) == 0  # no value: nothing to widen
    assert load(spark, dst, d20200104=[head, ("4", "1.5")], d20200102=[head, ("2", "8.25")]) == 1
    assert load(spark, dst, d20200105=[("v", "note"), ("5", "x")]) == 2  # a further column, another missing
    assert load(spark, dst, d20200101=[head, ("9", "70"), ("10", "71")]) == 2  # narrower: fits, and replaces the day
    got = WD.read_widened(spark, dst)
    assert {f.name: f.dataType for f in got.schema} == {"id": I, "v": D, "note": S, "date": T.DateType()}
    assert sorted(((str(r.date)[-2:], r.id, r.v, r.note) for r in got.collect()), key=str) == [
        ("01", 10, 71.0, None), ("01", 9, 70.0, None), ("02", 2, 8.25, None), ("03", 3, None, None), ("04", 4, 1.5, None), ("05", None, 5.0, "x")]
