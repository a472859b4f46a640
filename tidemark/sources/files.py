"""Folders on whatever file system a path names, through Spark's own Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _place(spark, path)
    return system.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if there is no such folder."""
    where, system = _place(spark, path)
    return [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    where, system = _place(spark, path)
    system.delete(where, True)
