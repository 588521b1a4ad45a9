"""Parquet tables in hash buckets of their key, so that an upsert rewrites only the buckets it touches.

A bucket is a partition folder; Spark's dynamic partition overwrite replaces the folders that a write has rows for and
leaves the files of the others as they are. The folder's name says how many buckets the table has.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from dqspark.operators.dedup import dedup
from dqspark.operators.joins import same_keys
from dqspark.operators.names import quoted
from dqspark.session import stored
from dqspark.sources.files import child_folders, file_exists, remove_folder

_BUCKET, _PENDING = "bucket_of_", "_pending"


class Change(NamedTuple):
    """An upsert's result: the table, the rows it wrote and the rows they replaced, and the buckets rewritten.

    ``after`` and ``before`` are written below the shared folder, the size of the source.
    """

    table: DataFrame
    after: DataFrame
    before: DataFrame
    buckets: list[int]


def bucket_column(spark: SparkSession, path: str) -> str | None:
    """The name of the table's bucket column; None where no table is."""
    names = [p.rstrip("/").rsplit("/", 1)[-1].partition("=")[0] for p in child_folders(spark, path)]
    return next((n for n in names if n.startswith(_BUCKET)), None)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The table without its bucket column."""
    column = bucket_column(spark, path)
    if column is None:
        raise FileNotFoundError(f"no bucketed table at {path}")
    return spark.read.parquet(path).drop(column)


def _bucket(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[quoted(c) for c in columns]), F.lit(buckets)).cast("int")


def buckets_of(table: DataFrame, rows: DataFrame, bucket_by: Sequence[str], column: str) -> list[int]:
    """The buckets in which keys of ``rows`` lie; at most as many as the table has."""
    typed = rows.select(*[quoted(c).cast(table.schema[c].dataType).alias(c) for c in bucket_by])
    found = typed.select(_bucket(bucket_by, int(column.removeprefix(_BUCKET))).alias("b")).distinct().collect()
    return sorted(r.b for r in found)


def read_keys(spark: SparkSession, path: str, rows: DataFrame, bucket_by: Sequence[str]) -> DataFrame:
    """The rows of those buckets in which keys of ``rows`` lie; other buckets are not read."""
    column = bucket_column(spark, path)
    if column is None:
        raise FileNotFoundError(f"no bucketed table at {path}")
    table = spark.read.parquet(path)
    return table.filter(F.col(column).isin(buckets_of(table, rows, bucket_by, column))).drop(column)


def typed_like(rows: DataFrame, table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows with the table's types; a key of another kind of type raises, as it could meet none of the table's."""
    types = {f.name.lower(): f.dataType for f in table.schema}
    for key in keys:
        own, wanted = rows.schema[key].dataType, types[key.lower()]
        if own != wanted and not (isinstance(own, NumericType) and isinstance(wanted, NumericType)):
            raise ValueError(f"key {key} is {own.simpleString()}, in {name} it is {wanted.simpleString()}")
    return rows.select(*[quoted(c).cast(types[c.lower()]).alias(c) if c.lower() in types else quoted(c) for c in rows.columns])


def kept_columns(rows: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the table's columns that they lack, as stored for their key; NULL for new keys."""
    have = {c.lower() for c in rows.columns}
    missing = [c for c in current.columns if c.lower() not in have]
    if not missing:
        return rows
    stored_values, same, names = same_keys(rows, current.select(*[quoted(c) for c in [*keys, *missing]]), keys)
    return rows.join(stored_values, same, "left").drop(*names)


def upsert_buckets(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: Sequence[Column] = (),
    bucket_by: Sequence[str] | None = None,
    buckets: int = 64,
    unique: bool = False,
    add_columns: bool = False,
) -> Change:
    """Merge ``source`` into a table: same key -> replaced, new key -> added. Only touched buckets are read and written.

    The first load makes the table with ``buckets`` buckets by the hash of ``bucket_by``, some of the keys (all by
    default); later calls find their number there. Choose so many that a bucket is some GB, and ``bucket_by`` so that an
    increment meets few: a key part that rows which change together share. The source is reduced to one row per key
    first (``dedup``), unless it is ``unique``. NULL in a key is a value.

    Columns that the source lacks keep their stored values, NULL in new rows. A column that the table lacks raises, or
    with ``add_columns`` is added, NULL in old rows; that writes all buckets once. A key of another type raises, numbers
    meet as the table's. A first load without rows writes nothing.

    The touched buckets' new rows are written to ``_pending`` in the table's folder first and only then put in place.
    A job that fails before leaves the table as it was; one that dies while folders are replaced is completed by the
    next upsert or ``recover``. Readers should wait while an upsert runs, as for any overwrite.
    """
    spark, by = source.sparkSession, list(bucket_by or keys)
    if not set(by) <= set(keys):
        raise ValueError("bucket_by must be some of the keys")
    recover(spark, path)
    column = bucket_column(spark, path)
    if column is None:
        column = f"{_BUCKET}{buckets}"
        table = None
    else:
        table = spark.read.parquet(path)
    if column.lower() in (c.lower() for c in source.columns):
        raise ValueError(f"the source has a column {column}")
    rows = source if unique else dedup(source, keys, order_by)
    count = int(column.removeprefix(_BUCKET))
    if table is None:
        after = stored(rows.withColumn(column, _bucket(by, count)), "upsert")
        merged, touched, before = after, _touched(after, column), after.limit(0)
        if not touched:
            return Change(rows.limit(0), after.drop(column), before.drop(column), [])
    else:
        current = table.drop(column)
        known = {c.lower() for c in current.columns}
        more = [c for c in rows.columns if c.lower() not in known]
        if more and not add_columns:
            raise ValueError(f"{path} has no column {', '.join(more)}")
        rows = stored(typed_like(rows, current, keys, path).withColumn(column, _bucket(by, count)), "upsert")
        touched = _touched(rows, column)
        if not touched:
            return Change(current, rows.drop(column), current.limit(0), [])
        met = table.filter(F.col(column).isin(touched))
        after = kept_columns(rows, met.drop(column), keys)
        if len(after.columns) > len(rows.columns):
            after = stored(after, "upsert")
        replaced, same, _ = same_keys(met, after.select(*[quoted(k) for k in keys]), keys)
        before = stored(met.join(replaced, same, "left_semi"), "upsert-before")
        if more:  # every file must have the new column
            met, touched = table, list(range(count))
            replaced, same, _ = same_keys(met, after.select(*[quoted(k) for k in keys]), keys)
        merged = met.join(replaced, same, "left_anti").unionByName(after, allowMissingColumns=True)
    # A bucket's rows come together, in as many files as its size asks for: AQE divides a large one.
    _write(merged.hint("rebalance", column), f"{path}/{_PENDING}", column, "errorifexists")
    recover(spark, path)
    return Change(read_buckets(spark, path), after.drop(column), before.drop(column), touched)


def _touched(rows: DataFrame, column: str) -> list[int]:
    return sorted(r[0] for r in rows.select(column).distinct().collect())


def _write(rows: DataFrame, path: str, column: str, mode: str) -> None:
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def recover(spark: SparkSession, path: str) -> None:
    """Put the buckets of a complete pending write in place; drop an incomplete one. Repeating it changes nothing."""
    pending = f"{path}/{_PENDING}"
    if file_exists(spark, f"{pending}/_SUCCESS"):
        column = bucket_column(spark, pending)
        if column:
            _write(spark.read.parquet(pending), path, column, "overwrite")
    if file_exists(spark, pending):
        remove_folder(spark, pending)
