"""What several operators of this subpackage need."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqspark.operators.joins import join_reduced


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its plain name, whatever dots or backticks that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


class Rows:
    """A frame under column names that no operator uses, so that no name of the input can clash or need quotes.

    ``frame`` has the columns ``c0``, ``c1``, ...; ``of`` maps a name to one of them. ``back`` returns a frame
    made from it to the old names, followed by the columns added: those replace input columns of the same name.
    """

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.of = {name: f"c{i}" for i, name in enumerate(self.names)}
        self.frame = df.select(*[quoted(name).alias(new) for name, new in self.of.items()])

    def back(self, df: DataFrame, *added: str) -> DataFrame:
        kept = [n for n in self.names if n.lower() not in {a.lower() for a in added}]
        return df.select(*[F.col(self.of[n]).alias(n) for n in kept], *added)


def word_count(text: Column) -> Column:
    """Words of a text, null counting as empty: each word becomes one sign, the white space goes, signs are counted."""
    signs = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x20\\x09-\\x0D]++", "w")
    return F.length(F.translate(signs, " \t\n\x0b\f\r", "")).cast("long")


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a text column, null as empty; one text at a time is copied."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str], rows: int) -> Iterator[pa.Table]:
    """Cut sorted batches anew so that no group is cut: tables of ``rows`` rows or one group more."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < rows:
            continue
        table = pa.concat_tables(held).combine_chunks()
        starts = group_starts(table, keys)
        if starts[-1]:
            yield table.slice(0, starts[-1])
            table = table.slice(starts[-1])
        held = [table]
    if held and (table := pa.concat_tables(held).combine_chunks()).num_rows:
        yield table


def group_starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """The first row of every group of equal keys in a sorted table of whole-number columns."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def meeting(rows: DataFrame, key: str, spread: Column, limit: int, sort: Sequence[str]) -> DataFrame:
    """Bring any two rows of equal ``key`` together in one bounded group, each group sorted.

    Keys of one row go, and null keys. A key with more than ``limit`` rows is split into parts by the hash of ``spread``
    and each two parts make a group, so that no task holds a large key whole: rows of one part are to be
    compared in the group (part, part) alone, rows of two parts in theirs. Adds ``part``, ``low`` and ``high``.
    """
    many = rows.groupBy(F.col(key).alias("_of")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    parts = F.ceil(F.col("_n") / limit).cast("int")
    dealt = (
        join_reduced(rows, many, key, "_of")
        .withColumn("part", F.pmod(F.xxhash64(spread), parts).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("low", F.least("part", "_other"))
        .withColumn("high", F.greatest("part", "_other"))
        .drop("_of", "_n", "_other")
    )
    return dealt.repartition(key, "low", "high").sortWithinPartitions(key, "low", "high", *sort)


def merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Components of rows linked by the pairs (a, b): each row's label is the lowest row it reaches.

    ``labels`` holds what earlier calls returned, at first ``arange``.
    """
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return labels
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(further := labels[labels], labels):
            labels = further


def mapped(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` under a name that says what goes in and out: record batches."""
    return df.mapInArrow(function, schema)
