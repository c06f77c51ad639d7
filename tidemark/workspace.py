"""Session settings and tables written to the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Read and print time texts in UTC (or ``zone``), so that results do not depend on the machine's zone."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, or the checkpoint dir set by code.

    Only a local session may go without one; it gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def table_path(spark: SparkSession, name: str) -> str:
    """A new folder for a table, inside the open ``scratch`` if there is one."""
    parent = _scratch.get()
    return f"{parent}/{name}-{uuid.uuid4().hex}" if parent else new_folder(spark, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and kept when executors are lost.

    Like checkpoint files, the table stays until the folder is cleared, unless ``scratch`` is open.
    """
    path = table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop the tables ``written`` inside the block when it ends: for jobs that run for ever, and batch jobs that use their results inside."""
    folder = new_folder(spark, "scratch")
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        drop_folder(spark, folder)


@contextmanager
def setting(spark: SparkSession, key: str, value: object | None) -> Iterator[None]:
    """Set a session option inside the block; None leaves it alone."""
    if value is None:
        yield
        return
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete ``path`` on whichever file system holds it; a missing path is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def has_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
