"""Parquet tables that are replaced as a whole, kept as numbered snapshot folders.

A write goes to the next number and counts only once Spark's commit has put ``_SUCCESS`` there,
so a job that loses executors or dies half way leaves the previous snapshot as the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dqspark.sources.files import child_folders, file_exists, remove_folder

_SNAPSHOT = "snapshot-"


def snapshots(spark: SparkSession, path: str) -> list[str]:
    """Committed snapshot folders of a table, oldest first."""
    return [p for p in _snapshot_folders(spark, path) if file_exists(spark, f"{p}/_SUCCESS")]


def _snapshot_folders(spark: SparkSession, path: str) -> list[str]:
    return [p for p in child_folders(spark, path) if p.rsplit("/", 1)[-1].startswith(_SNAPSHOT)]


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last committed write."""
    committed = snapshots(spark, path)
    if not committed:
        raise FileNotFoundError(f"no committed snapshot below {path}")
    return spark.read.parquet(committed[-1])


def write_snapshot(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Write the next snapshot and return it read back.

    ``keep`` committed snapshots stay, so that readers of the previous one can finish.
    """
    spark = df.sparkSession
    taken = _snapshot_folders(spark, path)
    number = 1 + max((int(p.rsplit(_SNAPSHOT, 1)[-1]) for p in taken), default=0)
    df.write.mode("errorifexists").parquet(f"{path}/{_SNAPSHOT}{number:08d}")
    for old in snapshots(spark, path)[:-keep]:
        remove_folder(spark, old)
    return read_snapshot(spark, path)
