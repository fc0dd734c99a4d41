"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# A hot key is split even where the split costs a later shuffle. The RocksDB store keeps streaming
# state off the heap, so that it may outgrow executor memory.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(app_name: str = "raceway", master: str | None = None, **conf: str) -> SparkSession:
    """Start or reuse a session; the master is left to spark-submit unless one is given."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: the one ``spark.checkpoint.dir`` names, or one in the warehouse.

    A path of the local file system may be a mount that all machines share, so on a cluster a job tries it once
    per application. Only a session whose tasks run in the driver gets, without that setting, a
    temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    alone = re.match(r"local(\[|$)", spark.sparkContext.master)
    if alone and not root:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="raceway-"))
        return spark.sparkContext.getCheckpointDir()
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    if not root and warehouse:
        root = f"{warehouse.rstrip('/')}/_scratch"
    if not alone and not (root and _reached(spark, root)):
        raise RuntimeError("spark.checkpoint.dir must name a folder that every executor can reach")
    return root


_REACHED: set[tuple[str, str]] = set()


def _reached(spark: SparkSession, root: str) -> bool:
    """Whether what tasks write below a folder is there for the driver and for other tasks.

    There are twice as many tasks as cores, so that each executor that runs is likely to write and to read.
    """
    if _file_system(spark, root)[0].getScheme() != "file":
        return True
    path = f"{root.rstrip('/')}/reach-{uuid.uuid4().hex}"
    try:
        tried = (spark.sparkContext.applicationId, root)
        if tried not in _REACHED:
            tasks = 2 * spark.sparkContext.defaultParallelism
            spark.range(0, tasks, 1, tasks).write.parquet(path)
            if spark.read.schema("id long").parquet(path).count() == tasks:
                _REACHED.add(tried)
        return tried in _REACHED
    except Exception as error:  # a folder that cannot be tried is none that all can reach
        raise RuntimeError(f"{root} is not a folder that every executor can reach") from error
    finally:
        remove_folder(spark, path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go when their statement ends, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a folder."""
    files, place = _file_system(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(place)]


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)


def move_folder(spark: SparkSession, new: str, path: str) -> None:
    """Let a finished folder appear, by one rename, at a path where nothing is yet."""
    files, place = _file_system(spark, path)
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(new), place):
        raise OSError(f"cannot put {new} at {path}")


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another.

    The old folder is set aside first and removed last, so one complete copy exists at any time.
    """
    files, place = _file_system(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.old-{uuid.uuid4().hex}")
    if files.exists(place) and not files.rename(place, aside):
        raise OSError(f"cannot set {path} aside")
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(new), place):
        raise OSError(f"cannot put {new} at {path}")
    files.delete(aside, True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path, not used before, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
