"""Small file-system calls on the driver through Hadoop's API, so they work on any store that Spark reads.

Only names of folders that a job keeps few of are listed here; data is read and written by Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str, oldest_first: bool = False) -> list[str]:
    """The names in a folder, sorted, or by the time of their last change; none if it is not there."""
    fs, p = _at(spark, path)
    found = [(s.getModificationTime() if oldest_first else 0, s.getPath().getName()) for s in (fs.listStatus(p) if fs.exists(p) else [])]
    return [name for _, name in sorted(found)]


def values(spark: SparkSession, path: str, key: str) -> list[str]:
    """The values of the partition folders ``key=value`` in a folder."""
    return [n[len(key) + 1:] for n in names(spark, path) if n.startswith(f"{key}=")]


def touch(spark: SparkSession, path: str) -> None:
    """An empty file (overwritten if there is one), with its folders."""
    fs, p = _at(spark, path)
    fs.create(p, True).close()


def delete(spark: SparkSession, path: str) -> None:
    """A file or folder goes, if it is there."""
    fs, p = _at(spark, path)
    fs.delete(p, True)
