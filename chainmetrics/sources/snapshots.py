"""Several tables published together: versioned manifests, one atomic switch.

A store is a folder of tables; each table is a set of parts (a month, a bucket), each part a folder
that is never changed. A commit first writes new folders for the parts it changes, of all
its tables, then one manifest that names every part of every table, under the next version
number, by a rename. Readers take the latest manifest: they see all tables of a load or
none. A load that breaks on the way leaves files that no manifest names; running it again
equals one load, since parts are replaced, not added to. Of two writers, one fails on the number.

``vacuum`` removes folders and manifests that the last versions don't need.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "_part"
ALL = "all"


@dataclass
class Change:
    """New rows of a table. ``part`` names the part of a row (letters, digits, "-"); parts that
    appear in ``rows`` or ``touched`` are replaced (and go, if no row is left), or all
    parts with ``whole``."""

    rows: DataFrame
    part: Column | None = None
    touched: Sequence[str] = ()
    whole: bool = False


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = f"{self.root}/_manifests"

    # -- reading ---------------------------------------------------------------

    def version(self) -> int:
        """The latest version; 0 before the first commit."""
        return max((int(n[:-5]) for n in self._names(self.manifests) if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """{table: {"schema": .., "parts": {part: folder}}} of a version (default: the latest)."""
        version = self.version() if version is None else version
        if not version:
            return {}
        return json.loads(self.spark.read.text(self._file(version), wholetext=True).first()[0])

    def has(self, table: str) -> bool:
        return table in self.manifest()

    def read(self, table: str, parts: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """A table as of a version; with ``parts`` the others are not even listed."""
        entry = self.manifest(version)[table]
        folders = [f for p, f in sorted(entry["parts"].items()) if parts is None or p in set(parts)]
        schema = StructType.fromJson(entry["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    # -- writing ---------------------------------------------------------------

    def commit(self, changes: Mapping[str, Change]) -> int:
        """Write all changes, then switch to them; returns the new version."""
        version = self.version() + 1
        manifest = self.manifest(version - 1)
        for table, change in changes.items():
            folder = f"{table}/{version:08d}-{uuid.uuid4().hex[:8]}"
            part = F.lit(ALL) if change.part is None else change.part
            (change.rows.withColumn(PART, part).hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(f"{self.root}/{folder}"))
            new = {n.removeprefix(f"{PART}="): f"{folder}/{n}" for n in self._names(f"{self.root}/{folder}") if n.startswith(f"{PART}=")}
            old = {} if change.whole else manifest.get(table, {"parts": {}})["parts"]
            kept = {p: f for p, f in old.items() if p not in set(change.touched)}
            manifest[table] = {"schema": json.loads(change.rows.schema.json()), "parts": kept | new}
        self._publish(version, json.dumps(manifest))
        return version

    def vacuum(self, keep: int = 1) -> int:
        """Remove what the last ``keep`` versions don't name, and older manifests; returns how many folders."""
        fs, path = self._fs()
        last = self.version()
        versions = [v for v in range(max(1, last - keep + 1), last + 1)]
        needed = {f.rsplit("/", 1)[0] for v in versions for t in self.manifest(v).values() for f in t["parts"].values()}
        gone = 0
        for table in self._names(self.root):
            if not table.startswith("_"):
                for folder in self._names(f"{self.root}/{table}"):
                    if f"{table}/{folder}" not in needed:
                        gone += bool(fs.delete(path(f"{self.root}/{table}/{folder}"), True))
        for v in range(1, last - keep + 1):
            fs.delete(path(self._file(v)), False)
        return gone

    # -- file system -----------------------------------------------------------

    def _file(self, version: int) -> str:
        return f"{self.manifests}/{version:08d}.json"

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs()
        return sorted(s.getPath().getName() for s in fs.listStatus(path(folder))) if fs.exists(path(folder)) else []

    def _publish(self, version: int, text: str) -> None:
        fs, path = self._fs()
        draft, final = path(f"{self.manifests}/.{uuid.uuid4().hex}"), path(self._file(version))
        out = fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"version {version} of {self.root} was published by another writer")
