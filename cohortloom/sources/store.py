"""Small files and folders in whatever store a path names: list, read, write once, rename, remove."""

from __future__ import annotations

from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _place(spark: SparkSession, path: str):
    """(file system, its path)"""
    jpath = _hadoop(spark).Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    system, jpath = _place(spark, path)
    return system.exists(jpath)


def children(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder with their modification times in milliseconds; none if the folder is not there."""
    system, jpath = _place(spark, folder)
    if not system.exists(jpath):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in system.listStatus(jpath)}


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder; 0 if it is not there."""
    system, jpath = _place(spark, path)
    return system.getContentSummary(jpath).getLength() if system.exists(jpath) else 0


def remove(spark: SparkSession, path: str) -> None:
    system, jpath = _place(spark, path)
    system.delete(jpath, True)


def touch(spark: SparkSession, path: str, changed: datetime) -> None:
    """Set a file's modification time, given in UTC."""
    system, jpath = _place(spark, path)
    system.setTimes(jpath, int(changed.replace(tzinfo=timezone.utc).timestamp() * 1000), -1)


def read_text(spark: SparkSession, path: str) -> str:
    system, jpath = _place(spark, path)
    stream = system.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str, draft: str) -> bool:
    """Write the whole text to `draft` and give it its name; False, and nothing changed, where the name is taken.

    Whoever reads `path` sees the whole text or no file: the name appears by one rename, which does not
    replace a file.
    """
    system, jpath = _place(spark, draft)
    stream = system.create(jpath, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop, gateway = _hadoop(spark), spark.sparkContext._gateway
    kind = getattr(hadoop, "Options$Rename")
    target = _place(spark, path)[1].makeQualified(system.getUri(), system.getWorkingDirectory())
    files = hadoop.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(jpath.makeQualified(system.getUri(), system.getWorkingDirectory()), target, gateway.new_array(kind, 0))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        system.delete(jpath, False)
        return False
