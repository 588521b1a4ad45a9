"""A roll-up of result rows that grows with the files that arrive, so that panels need not scan the results.

A folder ``part=N`` holds the counts of batch N of the stream, a folder ``sums/upto=N`` those of all batches up to N.
The counts are sums, so files that come late are counted like others, however late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dqspark.operators.names import quoted
from dqspark.sources.files import child_folders, file_exists, remove_folder

#: What a row of the roll-up is told apart by, if nothing else is asked for.
GRAIN = ("datetime", "table", "outcome")


def _numbered(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """The complete folders ``name=N`` below ``path``, by number."""
    found = {}
    for folder in child_folders(spark, path):
        label, _, number = folder.rstrip("/").rsplit("/", 1)[-1].partition("=")
        if label == name and number.isdigit() and file_exists(spark, f"{folder}/_SUCCESS"):
            found[int(number)] = folder
    return dict(sorted(found.items()))


def counted(results: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """How many result rows there are of each kind: the grain's columns and ``n``; NULL is a kind."""
    if "n" in (c.lower() for c in grain):
        raise ValueError("the grain must not have a column n")
    return results.groupBy(*[quoted(c) for c in grain]).agg(F.count(F.lit(1)).alias("n"))


def update_rollup(
    spark: SparkSession,
    results_path: str,
    schema: StructType,
    rollup: str,
    checkpoint: str,
    grain: Sequence[str] = GRAIN,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Count the result files not seen before into the roll-up, then stop.

    A batch that is run again, as its query died before it was marked as done, overwrites its own folder: each file counts
    once. Files without rows add a folder without rows.
    """

    def add(batch: DataFrame, number: int) -> None:
        if any(upto >= number for upto in _numbered(spark, f"{rollup}/sums", "upto")):
            return
        counted(batch, grain).write.mode("overwrite").parquet(f"{rollup}/part={number}")

    results = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(results_path)
    return (
        results.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _folders(spark: SparkSession, rollup: str) -> tuple[list[str], int]:
    """The folders that together count every batch once, and the last batch's number."""
    sums, parts = _numbered(spark, f"{rollup}/sums", "upto"), _numbered(spark, rollup, "part")
    base = max(sums, default=-1)
    later = [n for n in parts if n > base]
    return [*([sums[base]] if sums else []), *[parts[n] for n in later]], max([base, *later])


def read_rollup(spark: SparkSession, rollup: str) -> DataFrame:
    """The grain's columns and ``n``, a row per kind: equal to ``counted`` over all result files seen."""
    folders, last = _folders(spark, rollup)
    if last < 0:
        raise FileNotFoundError(f"no roll-up at {rollup}")
    parts = spark.read.parquet(*folders)  # named one by one, so that the folders' numbers are no columns
    kinds = [c for c in parts.columns if c != "n"]
    return parts.groupBy(*[quoted(c) for c in kinds]).agg(F.sum("n").alias("n"))


def fold_rollup(spark: SparkSession, rollup: str, keep: int = 2) -> None:
    """Add up the batches so far into one folder, so that their number does not grow; the last ``keep`` sums stay.

    The sum counts once it is written whole, and the batches in it no more; they are removed after, so a call that dies
    loses nothing, and the next one tidies up. Not to be run while the roll-up is updated.
    """
    folders, last = _folders(spark, rollup)
    if len(folders) > 1:
        read_rollup(spark, rollup).write.mode("overwrite").parquet(f"{rollup}/sums/upto={last}")
    sums = _numbered(spark, f"{rollup}/sums", "upto")
    base = max(sums, default=-1)
    old = [path for n, path in _numbered(spark, rollup, "part").items() if n <= base]
    for path in [*old, *list(sums.values())[:-keep]]:
        remove_folder(spark, path)
