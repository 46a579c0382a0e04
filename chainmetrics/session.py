"""Spark session and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on. Everything else (executor
# sizing, shuffle partitions at scale) belongs to the cluster submit config.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot accounts / transaction hashes: let AQE split skewed join partitions.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "chainmetrics",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names; without it the
    call fails, as a folder of one machine would lose rows. Only in local mode
    (tests) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None)
        if not root:
            if not (sc.master or "").startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="chainmetrics-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (test helpers that inspect written files)."""
    return path[5:] if path.startswith("file:") else path





def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its (Hadoop) file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def materialize(df):
    """Write a (small) intermediate result to the shared checkpoint folder and
    cut its lineage, so later passes (scalar subqueries, model fits) read it
    instead of recomputing the plan behind it. Survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def table_exists(spark: SparkSession, name_or_path: str) -> bool:
    """Catalog table or storage path exists (A11): picks create vs append."""
    if "/" in name_or_path:
        return path_exists(spark, name_or_path)
    return spark.catalog.tableExists(name_or_path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``chainmetrics`` importable in Python workers (once per application).

    Functions run in tasks (pandas UDFs, applyInPandas, mapInPandas) refer to
    this package's module-level helpers, so workers must import it. The package
    is zipped and handed to ``SparkContext.addPyFile`` (what ``--py-files``
    does); Spark serves it to every executor. The zip goes to the shared
    checkpoint folder when that is a local path (local mode, tests), else to
    a driver-side folder from which Spark distributes it.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark)
    folder = local_path(root) if root.startswith(("file:", "/")) else tempfile.mkdtemp(prefix="chainmetrics-pkg-")
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, f"chainmetrics-{app}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith((".py", ".csv")):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
