"""Day dumps as a data source of their own (A1): ``spark.read.format("day_dumps")``.

The source knows that a dump is one file per table and day (``<any>_<table>_YYYYMMDD.tsv[.gz]``,
or files in ``day=YYYYMMDD`` folders). Every day file is one partition, read as Arrow
batches; days outside ``start`` .. ``end`` are neither opened nor scheduled, and with ``pushdown`` the
same holds for filters on the day column, which the source takes over at planning time. As a stream its offsets are days: a batch reads
the days after the last one done, a restarted query goes on with the next day.

Options: ``path`` (any file system Arrow opens: local, hdfs, s3, gs), ``table`` (a folder below the path),
``start``, ``end`` (inclusive days), ``sep``, ``day`` (name of the day column, default ``date``), ``pushdown``
(default false: Spark 4.1 keeps the pushed filters with the loaded relation, so a frame that
takes filters over must serve one filter only; load another frame for another filter).
A schema must be given; columns that a file lacks are null, others of the file are left out.
A line that doesn't fit fails the read with its file's name, it is never skipped.

A day that lands after a later day was streamed isn't seen by the stream any more (its
offset has passed); it is loaded as a batch, by its date.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)
from pyspark.sql.types import StructType

from chainmetrics.session import ship_package
from chainmetrics.sources.dumps import FILE_DAY, FOLDER_DAY

NAME = "day_dumps"
BATCH_BYTES = 4 << 20


@dataclass
class DayFile(InputPartition):
    path: str
    day: dt.date

    def __init__(self, path: str, day: dt.date):
        super().__init__((path, day))
        self.path, self.day = path, day


def _day(text: str) -> dt.date | None:
    try:
        return dt.datetime.strptime(text, "%Y%m%d").date()
    except ValueError:
        return None


def _as_day(value) -> dt.date | None:
    if value in (None, ""):
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


class _Files:
    """The day files of a table, and how to read one."""

    def __init__(self, options: dict, schema: StructType):
        self.root = options["path"].rstrip("/")
        if table := options.get("table"):
            self.root += f"/{table}"
        self.table, self.sep, self.day = options.get("table", ""), options.get("sep", "\t"), options.get("day", "date")
        self.start, self.end = _as_day(options.get("start")), _as_day(options.get("end"))
        self.schema = schema

    def _store(self):
        from pyarrow import fs
        return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", self.root))

    def list(self) -> list[DayFile]:
        from pyarrow import fs
        store, root = self._store()
        out = []
        for f in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = f.base_name
            if f.type != fs.FileType.File or name.startswith(("_", ".")):
                continue
            found = re.search(FILE_DAY, name) or re.search(FOLDER_DAY, f.path)
            day = found and _day(found.group(1))
            if day and (self.start is None or day >= self.start) and (self.end is None or day <= self.end):
                out.append(DayFile(f.path, day))
        return sorted(out, key=lambda p: (p.day, p.path))

    def read(self, part: DayFile | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no day files at all
            return
        from pyarrow import csv
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(self.schema)
        fields = {f.name: f.type for f in arrow if f.name != self.day}
        store, _ = self._store()
        kind = "gzip" if part.path.endswith(".gz") else None
        with store.open_input_stream(part.path, compression=kind) as raw:
            try:
                reader = csv.open_csv(raw, read_options=csv.ReadOptions(block_size=BATCH_BYTES), parse_options=csv.ParseOptions(delimiter=self.sep),
                                      convert_options=csv.ConvertOptions(column_types=fields, include_columns=list(fields), include_missing_columns=True,
                                                                         strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=False))
                for batch in reader:
                    columns = [pa.array([part.day] * batch.num_rows, pa.date32()) if f.name == self.day else batch.column(f.name) for f in arrow]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
            except (pa.ArrowInvalid, OSError) as e:
                if "Empty CSV file" not in str(e):
                    raise ValueError(f"{part.path}: {e}") from e


class DayReader(DataSourceReader):
    def __init__(self, files: _Files):
        self.files = files

    def partitions(self) -> list[DayFile]:
        return self.files.list()

    def read(self, partition: DayFile) -> Iterator[pa.RecordBatch]:
        return self.files.read(partition)


class PrunedDayReader(DayReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of the day column narrow the days; all other filters stay with Spark."""
        one = dt.timedelta(days=1)
        for f in filters:
            if getattr(f, "attribute", None) != (self.files.day,):
                yield f
                continue
            if isinstance(f, In):
                days = [d for d in map(_as_day, f.value) if d is not None]
                low, high = (min(days), max(days)) if days else (dt.date.max, dt.date.min)
                yield f  # days between are left to Spark
            elif isinstance(f, EqualTo):
                low = high = _as_day(f.value)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                low, high = _as_day(f.value) + one * isinstance(f, GreaterThan), None
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                low, high = None, _as_day(f.value) - one * isinstance(f, LessThan)
            else:
                yield f
                continue
            if low is not None:
                self.files.start = max(low, self.files.start or low)
            if high is not None:
                self.files.end = min(high, self.files.end or high)


class DayStreamReader(DataSourceStreamReader):
    """Offsets are days: ``{"day": "YYYY-MM-DD"}``, the last one done ("" before the first)."""

    def __init__(self, files: _Files):
        self.files = files

    def initialOffset(self) -> dict:
        return {"day": ""}

    def latestOffset(self) -> dict:
        days = [p.day.isoformat() for p in self.files.list()]
        return {"day": max(days, default="")}

    def partitions(self, start: dict, end: dict) -> list[DayFile]:
        return [p for p in self.files.list() if start["day"] < p.day.isoformat() <= end["day"]]

    def read(self, partition: DayFile) -> Iterator[pa.RecordBatch]:
        return self.files.read(partition)


class DayDumpSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        raise ValueError("day_dumps needs a schema: spark.read.format('day_dumps').schema(...)")

    def reader(self, schema: StructType) -> DayReader:
        kind = PrunedDayReader if str(self.options.get("pushdown", "")).lower() == "true" else DayReader
        return kind(_Files(self.options, schema))

    def streamReader(self, schema: StructType) -> DayStreamReader:
        return DayStreamReader(_Files(self.options, schema))


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take over filters."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DayDumpSource)


def _options(root: str, table: str, start, end, sep: str) -> dict:
    return {"path": root, "table": table, "sep": sep} | {k: str(v) for k, v in (("start", start), ("end", end)) if v is not None}


def read_days(spark: SparkSession, root: str, table: str, schema: str, start=None, end=None, sep: str = "\t",
              pushdown: bool = False) -> DataFrame:
    """One table's day files as a batch; ``schema`` (DDL) names the file's columns, ``date`` is added.

    ``pushdown``: the one filter put on this frame prunes files, too."""
    register(spark)
    options = _options(root, table, start, end, sep) | {"pushdown": str(pushdown).lower()}
    return spark.read.format(NAME).schema(f"{schema}, date DATE").options(**options).load()


def stream_days(spark: SparkSession, root: str, table: str, schema: str, start=None, end=None, sep: str = "\t") -> DataFrame:
    """The same as a stream of days."""
    register(spark)
    return spark.readStream.format(NAME).schema(f"{schema}, date DATE").options(**_options(root, table, start, end, sep)).load()
