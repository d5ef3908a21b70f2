"""Cutting lineage and sizing partitions, for jobs that read an intermediate result more than once."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no checkpoint folder and all of Spark is on this machine, as in tests.
LOCAL_FOLDER = os.path.join(tempfile.gettempdir(), "strandwise-checkpoints")

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writing: dict[str, int | str | None] = {"n": 0, "before": None}
_cleared: set[str] = set()
_scopes = threading.local()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share. Where that is unset, one of this machine, if the executors are on it too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share; intermediate results are written there")
        folder = LOCAL_FOLDER
    return folder.rstrip("/")


def _delete(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone by then
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that `materialised` writes within it at its end, by which the results must have been used."""
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append(f"{checkpoint_folder(spark)}/strandwise-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}")
    try:
        yield
    finally:
        _delete(spark, stack.pop())


def _table_folder(spark: SparkSession) -> str:
    """The folder of the innermost scratch, or that of the application, which is deleted when the interpreter ends."""
    whole = f"{checkpoint_folder(spark)}/strandwise-{spark.sparkContext.applicationId}"
    if whole not in _cleared:
        _cleared.add(whole)
        atexit.register(_delete, spark, whole)
    stack = _scopes.__dict__.get("stack")
    return stack[-1] if stack else whole


@contextlib.contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of jobs within it go when the job ends; the setting comes back with the last thread that needs it."""
    with _lock:
        if not _writing["n"]:
            _writing["before"] = spark.conf.get(_DROP_SHUFFLES, None)
            spark.conf.set(_DROP_SHUFFLES, "true")
        _writing["n"] += 1
    try:
        yield
    finally:
        with _lock:
            _writing["n"] -= 1
            if not _writing["n"]:
                before = _writing["before"]
                spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


def materialised(frame: DataFrame) -> DataFrame:
    """The frame's rows, written once as a table to the shared folder; later reads don't compute them again, also after executors are lost.

    Parquet there takes a fraction of the room of a checkpoint, and its readers skip the columns they don't need. The table stands
    in for the shuffle files that led to it.
    """
    spark = frame.sparkSession
    path = f"{_table_folder(spark)}/{uuid.uuid4().hex}"
    with _dropping_shuffles(spark):
        frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions for an explicit repartitioning: as many as the session sets for shuffles."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A Parquet table of the folder, with the columns named (all, if none is)."""
    frame = spark.read.parquet(f"{folder}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def as_bigint(column: str) -> F.Column:
    """A decimal(20,0) key as bigint, null where it is too large for one."""
    return F.expr(f"try_cast({column} AS BIGINT)")
