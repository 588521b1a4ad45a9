"""Where jobs put the tables they must write between steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from dqspark.sources.files import remove_folder


#: Where the shared folder is named if the cluster names none; a session setting, so tests and benches can set it.
SHARED = "dqspark.shared.dir"

_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``, else ``SHARED``.

    Without either it is an error: a folder of one machine would be lost with that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED, None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; no two calls return the same one."""
    path = f"{shared_dir(spark)}/dqspark/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this process wrote to scratch paths, once no result is read from there."""
    while _made:
        remove_folder(spark, _made.pop())


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and return it read back.

    For a frame that several passes use: each pass then scans the columns it needs and repeats
    no joins, the scan knows the real size, and lost executors cost no more than their tasks.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def together(jobs: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Run independent writes at the same time: one's last tasks leave no executors idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}
