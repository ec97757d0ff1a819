"""Folders on whatever file system a path names.

The file system is that of the session: schemes and mount points set in the cluster's or in
the session's own configuration hold here as they do for Spark's readers and writers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _place(spark, path)
    return files.exists(where)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, where = _place(spark, path)
    files.delete(where, True)
