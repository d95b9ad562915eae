"""Folders of a store that only Spark's file systems reach: existence, listing, removal."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    fs, p = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder and all in it; whether it was there."""
    fs, p = _at(spark, path)
    return fs.delete(p, True)
