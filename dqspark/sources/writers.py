"""Table writes: keyed upsert, full replace, append of results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqspark.operators.dedup import dedup
from dqspark.operators.joins import same_keys
from dqspark.operators.names import quoted
from dqspark.session import scratch_path
from dqspark.sources.buckets import kept_columns, typed_like
from dqspark.sources.files import remove_folder
from dqspark.sources.snapshots import read_snapshot, snapshots, write_snapshot


#: Rows of a compressed CSV file at most.
ROWS_A_FILE = 250_000


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Headered CSV that ``read_csv`` reads back as it was, spaces included.

    ``compression`` names a codec, such as ``gzip``. A file is then read by one task, so a task that writes many rows
    makes several files.
    """
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    files = {"compression": compression, "maxRecordsPerFile": ROWS_A_FILE} if compression else {}
    df.write.options(header=True, escape='"', **spaces, **files).csv(path)


def upsert(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    order_by: Sequence[Column] = (),
    keep: int = 2,
    catalog: bool = False,
    unique: bool = False,
    add_columns: bool = False,
) -> DataFrame:
    """Merge ``source`` into a table: same key -> replaced, new key -> added. Returns the table.

    ``target`` is the path of a Parquet table kept as snapshots or, with ``catalog``, the name of a catalog table.
    The first load creates that table and its namespace; later ones need a table that supports MERGE (Delta,
    Iceberg), where only files with matches are rewritten. ``unique`` says that the source has one row per key
    already, as after a grouping by the keys, which saves a shuffle.

    A column that the source has and the table lacks raises; with ``add_columns`` it is added to a
    Parquet table, NULL in the old rows. A column that only a Parquet table has keeps its stored values, NULL in new
    rows. A key whose type is not the table's raises, unless both are numbers. The source is reduced to one row per key first. A NULL in a key equals a NULL there, and so
    it does in the merge; were it to match nothing, every run would add such rows again.
    """
    spark, rows = source.sparkSession, source if unique else dedup(source, keys, order_by)
    if catalog:
        if not spark.catalog.tableExists(target):
            ensure_namespace(spark, target.rpartition(".")[0]) if "." in target else None
            return materialize(rows, target)
        _no_more_columns(rows, spark.table(target), target)
        merge_into(rows, target, keys)
        return spark.table(target)
    if not snapshots(spark, target):
        return write_snapshot(rows, target, keep)
    return _merge_snapshot(rows, target, keys, keep, add_columns)


def _no_more_columns(rows: DataFrame, table: DataFrame, name: str) -> None:
    """Nothing is dropped in silence: columns that the table lacks are an error."""
    known = {c.lower() for c in table.columns}
    more = [c for c in rows.columns if c.lower() not in known]
    if more:
        raise ValueError(f"{name} has no column {', '.join(more)}")


def _merge_snapshot(
    rows: DataFrame, target: str, keys: Sequence[str], keep: int, add_columns: bool = False
) -> DataFrame:
    """The next snapshot: rows of the last one whose key the source lacks, and the source.

    The source is read twice and therefore written down first. That also gives the join its
    true size: small, and Spark broadcasts the source's key columns and leaves the target where
    it is; large, and both sides shuffle on the key.
    """
    spark = rows.sparkSession
    current, incoming = read_snapshot(spark, target), scratch_path(spark, "upsert")
    if not add_columns:
        _no_more_columns(rows, current, target)
    rows = kept_columns(typed_like(rows, current, keys, target), current, keys)
    more = [c for c in rows.columns if c.lower() not in {c.lower() for c in current.columns}]
    rows.select(*[quoted(c) for c in [*current.columns, *more]]).write.parquet(incoming)
    rows = spark.read.parquet(incoming)
    replaced, same, _ = same_keys(current, rows.select(*[quoted(k) for k in keys]), keys)
    merged = write_snapshot(current.join(replaced, same, "left_anti").unionByName(rows, allowMissingColumns=True), target, keep)
    remove_folder(spark, incoming)
    return merged


def merge_into(rows: DataFrame, table: str, keys: Sequence[str]) -> None:
    """MERGE rows, one per key, into a catalog table."""
    same = reduce(and_, [F.col(f"source.{k}").eqNullSafe(F.col(f"{table}.{k}")) for k in keys])
    merge = rows.alias("source").mergeInto(table, same)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def ensure_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Create an empty table with the columns of ``df`` unless it exists."""
    empty = df.sparkSession.createDataFrame([], df.schema)
    empty.write.format(fmt).mode("ignore").saveAsTable(name)


def insert_overwrite(df: DataFrame, name: str) -> None:
    """Replace all rows of an existing table; columns go by name, one that the table lacks raises."""
    table = df.sparkSession.table(name)
    _no_more_columns(df, table, name)
    df.select(*table.columns).write.insertInto(name, overwrite=True)


def materialize(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Write a model as a table, replacing the old one, and return the table."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
    return df.sparkSession.table(name)


def append_results(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Append result rows as Parquet; Spark gives every file of every run its own name."""
    writer = df.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
