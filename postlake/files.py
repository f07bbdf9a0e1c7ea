"""Folder listing through Hadoop's FileSystem, so any storage works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob, sorted; empty when there are none."""
    fs, target = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(target) or []))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it."""
    fs, target = _fs(spark, path)
    fs.create(target, False).close()


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a path."""
    fs, target = _fs(spark, path)
    return fs.getContentSummary(target).getLength()


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, to = _fs(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(_fs(spark, source)[1], to):
        raise OSError(f"cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)
