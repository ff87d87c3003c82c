"""Session set-up and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str, cpus: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it: ``spark.checkpoint.dir``, else a folder in the warehouse.

    A path on the machine's own file system may be a mount that all machines share, so outside local sessions it is tried out once.
    Only a session within one process that names none gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and (context.master == "local" or context.master.startswith("local[")):
        folder = tempfile.mkdtemp(prefix="foldmill-")
        context.setCheckpointDir(folder)
        return folder
    folder = folder or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "foldmill_shared")
    if not context.master.startswith("local") and is_machine_local(spark, folder):
        try_shared(spark, folder)
    return folder


_SHARED: set[tuple[str, str]] = set()


def try_shared(spark: SparkSession, folder: str) -> None:
    """Refuse a folder of which the driver does not see what executors write, or the other way round; once per application and folder."""
    tried = (spark.sparkContext.applicationId, folder)
    if tried in _SHARED:
        return
    path, tasks = os.path.join(folder, "foldmill", f"try-{uuid.uuid4().hex}"), max(2, spark.sparkContext.defaultParallelism)
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        seen = spark.read.schema("id long").parquet(path).count()
    except Exception as error:
        raise ValueError(f"{folder} can't be written and read by all executors; name a folder all executors share") from error
    remove_folder(spark, path)
    if seen != tasks:
        raise ValueError(f"{folder} lies on each machine's own disk; name a folder all executors share")
    _SHARED.add(tried)


def is_machine_local(spark: SparkSession, folder: str) -> bool:
    """Whether a path belongs to the machine's own file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate table that :func:`new_folder` made room for."""
    if f"{os.sep}foldmill{os.sep}" not in folder:
        raise ValueError(f"{folder} is not an intermediate folder")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; no two calls return the same one."""
    return os.path.join(shared_folder(spark), "foldmill", f"{name}-{uuid.uuid4().hex}")


def checkpoint(df):
    """Cut lineage through reliable storage, keeping partitions and row order as they are."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="foldmill-"), "foldmill")
    context.addPyFile(shutil.make_archive(target, "zip", root_dir=root, base_dir="foldmill"))
    _SHIPPED.add(context.applicationId)
