"""Folders of tables in whatever file system their path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _open(spark, path)
    return system.exists(place)


def make(spark: SparkSession, path: str) -> None:
    system, place = _open(spark, path)
    system.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _open(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Give a folder another name, in one step; nothing may have that name yet."""
    make(spark, new.rsplit("/", 1)[0])
    system, place = _open(spark, old)
    if not system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"cannot rename {old} to {new}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it does not exist."""
    system, place = _open(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def files(spark: SparkSession, path: str) -> list[str]:
    """All data files below a folder; names that begin with a dot or an underscore are none."""
    system, place = _open(spark, path)
    if not system.exists(place):
        return []
    found, walk = [], system.listFiles(place, True)
    while walk.hasNext():
        status = walk.next()
        if not status.getPath().getName().startswith((".", "_")):
            found.append(status.getPath().toString())
    return sorted(found)
