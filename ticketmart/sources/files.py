"""Folders of the shared file system, through the same Hadoop classes that Spark writes with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders right inside a folder; none if it does not exist."""
    path, files = _path(spark, folder)
    if not files.exists(path):
        return []
    return [str(status.getPath().toString()) for status in files.listStatus(path) if status.isDirectory()]


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)
