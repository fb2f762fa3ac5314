"""Session settings and shared-storage locations.

Scratch data (landed fixtures, staged rows, stream checkpoints) lives under the shared
folder the cluster names in ``spark.checkpoint.dir``. Only when that is unset (local
tests) is a temporary folder created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import SparkSession

# Settings every pipeline run relies on: UTC calendar days, ANSI casts (every cast of
# raw text is a try_*), AQE for runtime coalescing and skew splitting, dynamic
# partition overwrite for per-day rewrites of quarantine and the check log, timestamps in
# a Parquet type that has statistics (the default has none: a time filter skips no file),
# Parquet files in zstd (row hashes take half the bytes that snappy leaves them), and no
# generated method beyond the 8,000 bytes that the JVM compiles: it interprets longer ones,
# which made wide projections five times slower.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    master: str | None = None,
    app_name: str = "quayside",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above (plus the UI off for batch use)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    if (master or "").startswith("local"):
        # Local disk only: skip Hadoop's .crc side files (two files per output file).
        conf["spark.hadoop.fs.file.impl"] = "org.apache.hadoop.fs.RawLocalFileSystem"
        conf["spark.hadoop.fs.file.impl.disable.cache"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the pipeline depends on, on an existing session.

    Partition discovery of a day-partitioned table lists folders in a Spark job; its
    task count follows the cluster's parallelism instead of one task per folder.
    """
    conf = dict(REQUIRED_CONF)
    conf["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(
        max(1, spark.sparkContext.defaultParallelism)
    )
    for k, v in conf.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
        elif spark.conf.get(k, None) != v:
            raise RuntimeError(f"{k} must be {v} and cannot be set on this session")


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Temporarily change runtime SQL settings for the plans built and run inside."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def drops_shuffles(fn: Callable) -> Callable:
    """``fn(spark or frame, ...)``, whose writes remove their shuffle files as they end, not when the driver collects garbage.

    For functions that write each plan once and read the written tables from there on.
    """

    @wraps(fn)
    def run(first, *args, **kwargs):
        spark = first if isinstance(first, SparkSession) else first.sparkSession
        with session_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
            return fn(first, *args, **kwargs)

    return run


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one is set up only if none is configured."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quayside-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return (sc.getCheckpointDir() or conf_dir).rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    base = f"{checkpoint_root(spark)}/quayside-{spark.sparkContext.applicationId}"
    if unique:
        parts = parts + (uuid.uuid4().hex[:12],)
    return "/".join([base, *parts])


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a folder or file, on whatever store it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this application wrote; nothing if it is not there."""
    fs, folder = hadoop_path(spark, path)
    fs.delete(folder, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers (once per application).

    Operators that run Python inside tasks pickle functions by reference, so workers must
    be able to import ``quayside``. The package is zipped
    on the driver and distributed with ``SparkContext.addPyFile`` (harmless where it
    is already installed on the cluster image or passed with --py-files).
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    zip_path = os.path.join(tempfile.mkdtemp(prefix="quayside-pyfiles-"), "quayside.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.join("quayside", os.path.relpath(full, pkg_dir)))
    spark.sparkContext.addPyFile(zip_path)
    _SHIPPED.add(app)


@dataclass(frozen=True)
class Lakehouse:
    """Locations of the four pipeline tables under one root (raw may lie elsewhere)."""

    root: str
    raw_path: str | None = None

    @property
    def raw(self) -> str:
        return self.raw_path or f"{self.root}/raw/orders"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/orders"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/gold/orders_quarantine"

    @property
    def landing_rejects(self) -> str:
        return f"{self.root}/landing_rejects"

    @property
    def landed_files(self) -> str:
        return f"{self.root}/landed_files"

    @property
    def run_metrics(self) -> str:
        return f"{self.root}/run_metrics"

    @property
    def check_log(self) -> str:
        return f"{self.root}/gold/dq_run_log"

    @property
    def numbering(self) -> str:
        return f"{self.root}/gold/orders_numbering"

    @property
    def staging(self) -> str:
        return f"{self.root}/_staging"

    @staticmethod
    def fresh(spark: SparkSession, name: str = "lake") -> "Lakehouse":
        return Lakehouse(scratch_path(spark, name))


def local_path(uri: str) -> str:
    """Strip a file: scheme (for Python-side file writes in tests)."""
    if uri.startswith("file://"):
        return uri[len("file://") :]
    if uri.startswith("file:"):
        return uri[len("file:") :]
    return uri


__all__ = [
    "REQUIRED_CONF",
    "build_session",
    "apply_session_conf",
    "session_conf",
    "drops_shuffles",
    "checkpoint_root",
    "scratch_path",
    "hadoop_path",
    "drop_folder",
    "path_exists",
    "ship_package",
    "Lakehouse",
    "local_path",
]
