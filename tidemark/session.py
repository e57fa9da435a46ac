"""Sessions, table access and lineage cuts shared by every operator."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers then need no path of the driver's; the zip is some hundred kilobytes.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tidemark-ship-")), "tidemark.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, files in os.walk(root):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    archive.write(path, os.path.join("tidemark", os.path.relpath(path, root)))
    context.addPyFile(target)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; every reader goes through Spark, so any Hadoop path works."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows to all cores where the input has fewer partitions than the session has cores.

    Only a small or badly written input is shuffled; one with enough splits passes unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dimension(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """A broadcast hint if the table is counted to have at most ``rows`` rows, else the table as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where none is named, a local master gets a temporary one; on a cluster that is an error,
    since executors would write to disks of their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext._jsc.sc()
        held = context.getCheckpointDir()
        named = held.get() if held.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


_swept: set[str] = set()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the driver exits."""
    root = f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"
    if root not in _swept:
        _swept.add(root)
        atexit.register(remove_path, spark, root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Best-effort delete through Hadoop's file system API."""
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the context may be gone already
        pass


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The lineage ends in replicated files rather than in executor memory, so a lost
    executor costs only its running tasks, and the columns are pruned on reread.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._tidemark_path = path
    return made


def release(df: DataFrame) -> None:
    """Remove what ``cut`` wrote for this very frame; any other frame is left alone."""
    if path := getattr(df, "_tidemark_path", None):
        remove_path(df.sparkSession, path)
