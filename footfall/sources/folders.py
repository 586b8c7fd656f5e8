"""Listing and removing folders through Spark's own file systems, wherever a path lies."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """Hadoop's file system and path object for ``path``."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote the folder has committed."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders and files directly below ``path``, hidden ones left out; none without a folder."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    found = [status.getPath().getName() for status in system.listStatus(where)]
    return sorted(name for name in found if not name.startswith(("_", ".")))


def values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partition column whose folders lie directly below ``path``."""
    return [name.split("=", 1)[1] for name in names(spark, path) if name.startswith(f"{column}=")]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder; nothing happens if it is gone already."""
    system, where = _at(spark, path)
    system.delete(where, True)
