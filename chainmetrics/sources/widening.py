"""Day files whose column types differ between loads (A2).

Types are inferred for each load, from all of its rows. A load that fits the stored types is
cast to them and added to the newest version of the table; one that needs wider types or
brings further columns opens the next version, a folder of its own with the wider schema.
Nothing stored is rewritten. Reading casts every version to the newest schema and takes
each day from the last version that holds it, so a day loaded again is replaced.

Wider: int < bigint < double, date < timestamp, whole decimals beyond 64 bits with int and
bigint; any other two types meet as string (a stored number then reads as Spark prints it). A
column without any value in a load asks for nothing; columns that a load lacks are null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmetrics.session import path_exists, scratch_path
from chainmetrics.sources import dumps as D

NUMBERS = (T.IntegerType(), T.LongType(), T.DoubleType())
TIMES = (T.DateType(), T.TimestampType())
BIG = T.DecimalType(38, 0)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """Narrowest type that holds the values of both."""
    if a == b:
        return a
    for line in (NUMBERS, TIMES):
        if a in line and b in line:
            return line[max(line.index(a), line.index(b))]
    whole = [x for x in (a, b) if isinstance(x, T.DecimalType) and x.scale == 0 or x in NUMBERS[:2]]
    return BIG if len(whole) == 2 else T.StringType()


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both, each with the wider type, the old ones first."""
    types = {f.name: f.dataType for f in old}
    for f in new:
        types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def fitted(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    """``df`` with the columns and types of a schema; missing columns are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema], *more)


def _versions(spark: SparkSession, dst: str) -> list[str]:
    out = []
    while path_exists(spark, path := f"{dst.rstrip('/')}/version-{len(out)}"):
        out.append(path)
    return out


def _columns(table: DataFrame, partition_by: str) -> T.StructType:
    return T.StructType([f for f in table.schema if f.name != partition_by])


def add_load(spark: SparkSession, src: str, dst: str, sep: str = "\t", partition_by: str = "date") -> int:
    """Add a folder of day files; returns the number of the version that took it.

    Lines that don't fit the types of their load are kept in ``<dst>_rejected`` of the load's
    staging table, as ``dumps.tsv_to_parquet`` does."""
    load = D.tsv_to_parquet(spark, src, scratch_path(spark, "load"), sep, partition_by)
    load = load.drop("day")  # the folder's name, not a column of the files
    columns = _columns(load, partition_by)
    text = [f.name for f in columns if f.dataType == T.StringType()]
    filled = load.agg(*[F.count(c).alias(c) for c in text]).first().asDict() if text else {}
    versions = _versions(spark, dst)
    old = _columns(spark.read.parquet(versions[-1]), partition_by) if versions else T.StructType([])
    schema = merged(old, T.StructType([f for f in columns if filled.get(f.name, 1) or f.name not in old.names]))
    number = len(versions) - (1 if versions and schema == old else 0)
    D.write_day_partitions(fitted(load, schema, partition_by), f"{dst.rstrip('/')}/version-{number}", partition_by)
    return number


def read_widened(spark: SparkSession, dst: str, partition_by: str = "date") -> DataFrame:
    """The whole table in its newest schema."""
    tables = [spark.read.parquet(p) for p in _versions(spark, dst)]
    schema = _columns(tables[-1], partition_by)
    out, later = fitted(tables[-1], schema, partition_by), tables[-1].select(partition_by).distinct()
    for table in reversed(tables[:-1]):
        # A row per day: what later versions hold is left out here.
        out = out.unionByName(fitted(table, schema, partition_by).join(later, partition_by, "left_anti").select(*out.columns))
        later = later.union(table.select(partition_by).distinct()).distinct()
    return out
