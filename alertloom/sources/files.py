"""Folders of the shared file system, listed and deleted through the file system that Spark reads them with."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none if it isn't there."""
    fs, folder = _at(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _at(spark, path)
    return fs.exists(folder)


def delete(spark: SparkSession, path: str) -> bool:
    fs, folder = _at(spark, path)
    return fs.delete(folder, True)
