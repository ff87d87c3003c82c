"""Small files that one writer wins: claims and commit markers, through the file system that a path names."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _handle(spark, path)
    return system.exists(target)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its whole content unless it is there already; whether this call made it.

    The content is written beside it and then given the name, so that no reader sees half a file. The name is taken by a link on a machine's own disk, elsewhere by a
    rename, which a file system such as HDFS refuses if the name is taken.
    """
    target, system = _handle(spark, path)
    system.mkdirs(target.getParent())
    beside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside)
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if system.getScheme() != "file":
            return not system.exists(target) and system.rename(draft, target)
        try:
            os.link(urlparse(beside).path, urlparse(path).path)
        except FileExistsError:
            return False
        return True
    finally:
        system.delete(draft, False)


def newest(spark: SparkSession, folder: str) -> tuple[str, str] | None:
    """Name and content of the file of the highest name in a folder, if there is one."""
    target, system = _handle(spark, folder)
    if not system.exists(target):
        return None
    names = sorted(s.getPath().getName() for s in system.listStatus(target))
    names = [n for n in names if not n.startswith(".")]
    if not names:
        return None
    stream = system.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, names[-1]))
    try:
        return names[-1], bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    target, system = _handle(spark, path)
    system.delete(target, False)
