"""Folder listing on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below ``path``, sorted; hidden ones and a missing path give none."""
    fs, folder = _open(spark, path)
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory()]
    return sorted(p.toString() for p in found if not p.getName().startswith(("_", ".")))


def file_exists(spark: SparkSession, path: str) -> bool:
    fs, file = _open(spark, path)
    return fs.exists(file)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _open(spark, path)
    fs.delete(folder, True)
