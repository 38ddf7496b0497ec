"""Intermediate tables in the folder all executors share.

A written table survives the loss of executors, cuts the lineage and gives
Catalyst true file sizes, so that it picks broadcast or shuffle joins from facts
instead of guesses. `release` removes what an application has written there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


# Folders of one machine's file system that an application's tasks were found to share.
_REACHED: set[tuple[str, str]] = set()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: spark.checkpoint.dir, or what was set in its place.

    Without that setting it is the checkpoint folder given to the SparkContext, else the
    warehouse, which all executors reach as well. A plain path serves a session whose executors
    all run on this machine. On a cluster it may be a mount of all machines: rows written there
    by tasks must be found again, else it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or _other_folder(spark)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    master = spark.conf.get("spark.master", "")
    default = spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")
    return checked_folder(folder, master, default, lambda found: _reached(spark, found))


def _other_folder(spark: SparkSession) -> str | None:
    context = getattr(spark, "sparkContext", None)
    return (context and context.getCheckpointDir()) or spark.conf.get("spark.sql.warehouse.dir", None)


def checked_folder(
    folder: str, master: str, default: str = "file:///", reached: Callable[[str], bool] = lambda folder: False
) -> str:
    """`folder`, if it is on shared storage, if all runs on one machine, or if it is `reached`."""
    folder = folder.rstrip("/")
    scheme = folder.partition(":")[0] if ":" in folder else default.partition(":")[0]
    if scheme == "file" and not master.startswith("local") and not reached(folder):
        raise RuntimeError(f"spark.checkpoint.dir is {folder}, which the executors of {master} do not share")
    return folder


def _reached(spark: SparkSession, folder: str) -> bool:
    """Whether rows that tasks on all cores write to `folder` are found again, tried once per application."""
    app = spark.conf.get("spark.app.id", "app")
    if (app, folder) not in _REACHED:
        path = f"{folder}/tradeloom/{app}/reached-{uuid.uuid4().hex}"
        tasks = 4 * spark.sparkContext.defaultParallelism
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        if spark.read.schema("id bigint").parquet(path).count() < tasks:
            return False
        _REACHED.add((app, folder))
    return True


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tradeloom/{spark.conf.get('spark.app.id', 'app')}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the application's folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


# Where the tables that `materialize` returned lie.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(frame: DataFrame, label: str, codec: str | None = None, spent: DataFrame | None = None) -> DataFrame:
    """Write `frame` once and go on from the written table.

    `codec` compresses it otherwise than by default. `spent` is a table written here that nothing
    reads any more once this one is written: it is removed.
    """
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    writer = frame.write.option("compression", codec) if codec else frame.write
    with shuffles_dropped(spark):
        writer.parquet(path)
    if spent is not None and getattr(spark, "_jvm", None):
        _remove(spark, _PATHS[spent])
    table = spark.read.schema(frame.schema).parquet(path)
    _PATHS[table] = path
    return table


def compressed(frame: DataFrame, label: str, spent: DataFrame | None = None) -> DataFrame:
    """materialize for rows with ids, which zstd keeps in two thirds of the default's room."""
    return materialize(frame, label, "zstd", spent)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind; else they stay until the driver's next full GC."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def release(spark: SparkSession) -> None:
    """Remove this application's tables; results that read them must have been used before."""
    _remove(spark, _own_folder(spark))


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
