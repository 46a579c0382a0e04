"""Raw day dumps: TSV readers, conversion to parquet, landing writes.

Day files are named ``<anything>_<table>_YYYYMMDD.tsv[.gz]`` (one file per
table per day) or live in ``day=YYYYMMDD`` folders. The day is read from the
file path (``_metadata.file_path``); filters on it prune whole files before
they are opened. gzip is decompressed by the reader itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chainmetrics.session import path_exists, scratch_path

CORRUPT = "_corrupt_record"
FILE_DAY = r"_(\d{8})\."          # <prefix>_<table>_YYYYMMDD.tsv[.gz]
FOLDER_DAY = r"/(?:day|date)=(\d{8})/"  # .../day=YYYYMMDD/part-...


def with_file_day(df: DataFrame, col: str = "date") -> DataFrame:
    """Day of each row from its file name, else from its day folder."""
    def grab(c, pattern):
        return F.nullif(F.regexp_extract(F.col(c), pattern, 1), F.lit(""))
    day = F.coalesce(grab("_metadata.file_name", FILE_DAY), grab("_metadata.file_path", FOLDER_DAY))
    return df.withColumn(col, F.try_to_date(day, "yyyyMMdd"))


def read_dumps(spark: SparkSession, root: str, table: str, start=None, end=None,
               schema: StructType | str | None = None, sep: str = "\t") -> DataFrame:
    """One table's day dumps for ``start <= day <= end`` (inclusive; open when None) (A1).

    Without a schema every column is read as text; pass the declared schema in
    production (inference reads the data twice).
    """
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    df = with_file_day(reader.csv(f"{root.rstrip('/')}/{table}/"), "date")
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    return df


def tsv_to_parquet(spark: SparkSession, src: str, dst: str, sep: str = "\t", partition_by: str = "date",
                   schema: StructType | str | None = None, rejected: str | None = None) -> DataFrame:
    """Convert a folder of day TSVs to parquet partitioned by day (A2).

    Pass the declared ``schema`` in production; without it types are inferred from ALL
    rows first (one more read of the data). Lines that don't fit it (too many or too few
    fields, values of another type) are kept as they are, with their file, in the side
    table ``rejected`` (default: ``<dst>_rejected``); the others are written to ``dst``. The lines are
    parsed once for ``dst`` and, only if some don't fit, once more for ``rejected``.
    Returns the written table, read back.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is None:
        schema = reader.option("inferSchema", True).option("samplingRatio", 1.0).csv(src).schema
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    raw = (reader.option("columnNameOfCorruptRecord", CORRUPT)
           .schema(StructType([*schema.fields, StructField(CORRUPT, StringType())])).csv(src))
    # Always parsed with all columns: what counts as malformed must not depend on the columns read.
    parsed, bad = with_file_day(raw, partition_by), F.col(CORRUPT).isNotNull()
    seen = Observation()

    def fitting(rows):
        return rows.observe(seen, F.count_if(bad).alias("bad")).where(~bad).drop(CORRUPT)

    # Counted after the shuffle: without a fitting line there would be no stage left that counts.
    write_day_partitions(parsed, dst, partition_by, then=fitting)
    lines = spark.createDataFrame([], StructType([StructField("_file", StringType()), StructField("line", StringType()), parsed.schema[partition_by]]))
    if seen.get["bad"]:
        staged = scratch_path(spark, "misfits")
        with_file_day(raw.withColumn("_file", F.col("_metadata.file_path")), partition_by).where(bad).write.parquet(staged)
        lines = spark.read.parquet(staged).select("_file", F.col(CORRUPT).alias("line"), partition_by)
    lines.write.mode("overwrite").parquet(rejected or f"{dst.rstrip('/')}_rejected")
    return spark.read.schema(parsed.drop(CORRUPT).schema).parquet(dst)


def load_tables(spark: SparkSession, root: str, dst: str, schemas: dict[str, StructType | str], start=None, end=None) -> dict[str, DataFrame]:
    """Load the day dumps of several tables for ``start <= day <= end`` into day-partitioned
    tables below ``dst`` (A1 + A4): the first load creates a table, later ones replace the
    days they bring. Returns the stored tables by name."""
    out = {}
    for table, schema in schemas.items():
        rows = read_dumps(spark, root, table, start, end, schema)
        write_day_partitions(rows, f"{dst.rstrip('/')}/{table}")
        out[table] = spark.read.schema(rows.schema).parquet(f"{dst.rstrip('/')}/{table}")
    return out


def write_day_partitions(df: DataFrame, path: str, day_col: str = "date", fmt: str = "parquet",
                         options: dict | None = None, then=lambda rows: rows) -> None:
    """Write ``df`` partitioned by day, replacing only the days present in ``df`` (A4, A8);
    ``then`` is applied to the rows brought together.

    Dynamic partition overwrite makes a re-run of the same days idempotent
    (no duplicated rows) while leaving other days untouched. The rebalance hint
    brings a day's rows together and splits days beyond the advisory partition
    size, so a hot day is written by as many tasks as its size needs and a cold
    day by one.
    """
    w = then(df.hint("rebalance", F.col(day_col))).write.mode("overwrite")
    # A new table is simply created (no staging of replaced days); an existing
    # one gets only the days present in ``df`` replaced (A11: create vs insert).
    if path_exists(df.sparkSession, path):
        w = w.option("partitionOverwriteMode", "dynamic")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.partitionBy(day_col).format(fmt).save(path)


def publish_range(table: DataFrame, path: str, start=None, end=None, day_col: str = "Date") -> DataFrame:
    """Publish the days of a daily table within ``start .. end`` (inclusive), sorted by day
    (B14 + F1 + A8): the days replace what was published for them before. Returns the
    published table. The table has one row per day, so it is one sorted file per range part."""
    df = table
    if start is not None:
        df = df.where(F.col(day_col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(day_col) <= F.lit(end).cast("date"))
    # Folders of a year: a daily table has a few hundred rows in each.
    year = F.date_format(day_col, "yyyy")
    w = df.withColumn("year", year).hint("rebalance", F.col("year"))
    spark = table.sparkSession
    if path_exists(spark, path):
        # A year may be published in parts: its other days are kept.
        days, years = df.select(day_col), w.select("year").distinct()
        old = spark.read.parquet(path).withColumn("year", year).join(years, "year", "left_semi").join(days, day_col, "left_anti")
        staged = scratch_path(spark, "publish")
        w.unionByName(old.select(*w.columns)).write.parquet(staged)
        w = spark.read.parquet(staged).hint("rebalance", F.col("year"))
        writer = w.sortWithinPartitions("year", day_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = w.sortWithinPartitions("year", day_col).write.mode("overwrite")
    writer.partitionBy("year").parquet(path)
    return spark.read.parquet(path).drop("year")


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a whole result table."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_landing(df: DataFrame, path: str, fmt: str = "json", day_col: str | None = "date") -> None:
    """Land raw feed rows as JSON or CSV, one folder per day."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.option("header", True)
    if day_col:
        w = w.partitionBy(day_col)
    w.format(fmt).save(path)


def read_report_pages(spark: SparkSession, path: str) -> DataFrame:
    """Report pages stored as JSON documents ``{"data": [{"address": ...}]}``."""
    return spark.read.schema("data ARRAY<STRUCT<address: STRING>>").option("multiLine", True).json(path)


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """Daily report CSV with an ``address`` column."""
    return spark.read.option("header", True).csv(path).select(F.col("address").alias("account"))
