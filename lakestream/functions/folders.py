"""Folders of a file system that Spark reaches, through Hadoop's public FileSystem interface."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: How Spark's writers name the directory of a null partition value and the file that says a folder is complete, and the
#: characters they escape in directory names (fixed values).
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
COMPLETE = "_SUCCESS"
ESCAPED = "\"#%'*/:=?\\{[]^\x7f"


def folder_of(column: str, value: str | None) -> str:
    """The directory of a partition value, as Spark's writers name it."""
    if value is None or value == "":
        return f"{column}={NULL_FOLDER}"
    text = "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in value)
    return f"{column}={text}"


def _reach(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder and what is in it; False if there is none."""
    system, place = _reach(spark, path)
    return bool(system.delete(place, True))


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly inside `path`, sorted; none if it does not exist."""
    system, place = _reach(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _reach(spark, path)
    return bool(system.exists(place))


def mark_complete(spark: SparkSession, path: str) -> None:
    """Put the empty file that says a folder is complete, as Spark's writers do, into a folder written without it."""
    system, place = _reach(spark, f"{path}/{COMPLETE}")
    system.create(place, True).close()
