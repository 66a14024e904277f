"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

# Settings the library's results depend on, plus the runtime re-planning its
# large joins profit from. A cluster's own values win for everything else.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "filmloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Spark then removes the files of a write's shuffles when the write ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folders up to which every task writes a file in each; rows for more are gathered by folder first, which moves them all.
FEW_FOLDERS = 16

_local_root: str | None = None
# Paths that ``materialise`` wrote inside each ``short_lived`` that is open, the innermost last.
_short: ContextVar[tuple[list[str], ...]] = ContextVar("short", default=())


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables that cut lineage.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    _local_root = _local_root or tempfile.mkdtemp(prefix="filmloom-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def save(spark: SparkSession, writer: DataFrameWriter, path: str) -> None:
    """Write Parquet files that take little room, and leave nothing of the write's shuffles behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        writer.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def by_folder(df: DataFrame, folders: int, *columns: str) -> DataFrame:
    """``df`` as it is to be written to so many folders ``columns``."""
    return df if folders <= FEW_FOLDERS else df.hint("rebalance", *columns)


@contextmanager
def short_lived(spark: SparkSession) -> Iterator[None]:
    """What ``materialise`` writes inside is deleted at the end, unless it is to outlive the block: for work of which
    nothing else stays but stored tables."""
    paths: list[str] = []
    before = _short.set((*_short.get(), paths))
    try:
        yield
    finally:
        _short.reset(before)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), outlives: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it.

    The written table outlives lost executors, is computed once however often
    the result is read, and keeps column pruning and filter pushdown.
    ``outlives`` says that it is needed after the innermost ``short_lived``.
    """
    path = scratch_path(df.sparkSession, label)
    if held := _short.get()[: -1 if outlives else None]:
        held[-1].append(path)
    save(df.sparkSession, df.write.partitionBy(*partition_by), path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
