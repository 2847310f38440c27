"""Marker files on any file system that Spark reaches."""

from __future__ import annotations

from pyspark.errors import IllegalArgumentException
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def create_new(spark: SparkSession, path: str) -> bool:
    """Makes an empty file if there is none; of several callers one gets True."""
    system, place = _at(spark, path)
    try:
        system.mkdirs(place.getParent())
        return bool(system.createNewFile(place))
    except (Py4JJavaError, IllegalArgumentException):
        if system.exists(place):
            return False
        raise


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if there is no folder."""
    system, place = _at(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def fingerprint(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """Path, size and time of change of every file below a folder; empty without one."""
    system, place = _at(spark, folder)
    found = []
    if system.exists(place):
        files = system.listFiles(place, True)
        while files.hasNext():
            status = files.next()
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder that this application made."""
    system, place = _at(spark, path)
    system.delete(place, True)
