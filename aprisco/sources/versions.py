"""Directories that are replaced as a whole: each write goes to a new version path.

A version counts once its write job has left the ``_SUCCESS`` marker, so a reader never sees
half a table, a failed write changes nothing, and no job overwrites what it is reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _list(spark: SparkSession, path: str) -> list[int]:
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    numbers = []
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        finished = fs.exists(hadoop.Path(status.getPath(), "_SUCCESS"))
        if name.startswith("table_version=") and finished:
            numbers.append(int(name.split("=")[1]))
    return sorted(numbers)


def version_path(path: str, number: int) -> str:
    return f"{path}/table_version={number:08d}"


def complete_versions(spark: SparkSession, path: str) -> list[str]:
    """Paths of the finished versions, oldest first."""
    return [version_path(path, n) for n in _list(spark, path)]


def latest_number(spark: SparkSession, path: str) -> int:
    """Number of the newest finished version; 0 if there is none."""
    return max(_list(spark, path), default=0)


def write_next(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a whole new version and return its path."""
    target = version_path(path, latest_number(df.sparkSession, path) + 1)
    # Static: what a failed attempt left under this number is replaced as a whole.
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    return target


def drop_partition(spark: SparkSession, versions: Sequence[str], name: str) -> None:
    """Delete one partition of each of these versions, where they have it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for version in versions:
        part = hadoop.Path(version, name)
        part.getFileSystem(spark._jsc.hadoopConfiguration()).delete(part, True)


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest finished versions of a table and return what was deleted.

    For the replica, dimensions and facts, which every version holds whole. Never for a
    history, whose older versions hold what they closed. Readers of an older version must be
    done; ``keep`` leaves them a margin.
    """
    if keep < 1:
        raise ValueError("at least the newest version is kept")
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    versions = complete_versions(spark, path)
    old = versions[:-keep]
    for version in versions:
        if fs.globStatus(hadoop.Path(version, "scd_state=*")):
            raise ValueError(f"{path} is a history; its versions belong together")
    for version in old:
        fs.delete(hadoop.Path(version), True)
    return old
