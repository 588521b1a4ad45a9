"""Filters that return the rows breaking a condition."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from dqspark.operators.joins import join_reduced, same_keys
from dqspark.operators.names import quoted, type_of, unlike


def violations_below(df: DataFrame, column: str, bound: float = 0) -> DataFrame:
    return df.filter(quoted(column) < bound)


def violations_between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows outside [low, high]; the offending value is repeated as ``invalid_value``."""
    value = quoted(column)
    return df.filter((value < low) | (value > high)).withColumn("invalid_value", value)


def violations_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(quoted(column).isNull())


def as_key(df: DataFrame, column: str, other: DataFrame, other_column: str) -> Column:
    """A key to be compared with another table's: text is read as what the other side holds, a number, a date, a time.

    Text that is none becomes NULL, which no key equals.
    """
    own, type_ = type_of(df, column), type_of(other, other_column)
    mixed = isinstance(own, StringType) and not isinstance(type_, StringType)
    return F.trim(quoted(column)).try_cast(type_) if mixed else quoted(column)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows of ``child`` whose key has no parent; a NULL key refers to nothing and is left out.

    Where one side is text and the other is not, they meet as the other (``as_key``), and text that is none is
    an orphan. Either side may have a hot key: parent keys are made distinct, which combines them on the
    map side, and the join lets AQE split the child's.
    """
    own, other = unlike(child.columns, "_fk"), unlike(child.columns, "_pk")
    known = parent.select(as_key(parent, pk, child, fk).alias(other)).distinct()
    if not isinstance(type_of(child, fk), StringType) or type_of(child, fk) == type_of(parent, pk):
        return join_reduced(child, known, fk, other, "left_anti")
    read = child.withColumn(own, as_key(child, fk, parent, pk))
    unread = read.filter(quoted(fk).isNotNull() & F.col(own).isNull())
    return join_reduced(read, known, own, other, "left_anti").union(unread).drop(own)


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of every key that occurs more than once; rows whose key is all NULL are left out.

    See ``repeated_keys``; the semi join back lets AQE split a hot key, so no task ever holds the rows of one key.
    """
    repeated, same, _ = same_keys(df, repeated_keys(df, keys), keys)
    return df.join(repeated, same, "left_semi")


def repeated_keys(df: DataFrame, keys: Sequence[str], bits: int = 64) -> DataFrame:
    """Keys that occur more than once, one row each, those all NULL left out. Exact, in two phases.

    First rows are counted by an 8-byte hash of their key, so that wide keys do not cross the network. Only rows whose
    hash occurs again are then read with their whole keys, which are counted as they are: equal hashes of unlike keys
    cost a little and change nothing. ``bits`` cuts the hash, for tests. Hashes are counted on the map side and joined
    so that Spark may split a hot one.
    """
    own, counted, other = [unlike(df.columns, n) for n in ("_hash", "_n", "_of")]
    present = df.select(*[quoted(k) for k in keys]).filter(reduce(or_, [quoted(k).isNotNull() for k in keys]))
    hashed = present.withColumn(own, F.shiftrightunsigned(F.xxhash64(*[quoted(k) for k in keys]), 64 - bits))
    again = hashed.groupBy(F.col(own).alias(other)).agg(F.count(F.lit(1)).alias(counted)).filter(F.col(counted) > 1)
    candidates = join_reduced(hashed, again.select(other), own, other, "left_semi")
    names = [quoted(k) for k in keys]
    return candidates.groupBy(*names).agg(F.count(F.lit(1)).alias(counted)).filter(F.col(counted) > 1).select(*names)
