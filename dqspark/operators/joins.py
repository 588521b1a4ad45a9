"""The join of rows that may have hot keys with a frame reduced to few rows per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame

from dqspark.operators.names import quoted, unlike


def join_reduced(
    rows: DataFrame, reduced: DataFrame, key: str, reduced_key: str, how: str = "inner"
) -> DataFrame:
    """Join ``rows.key = reduced.reduced_key``; a NULL key matches nothing.

    ``reduced`` comes out of a grouping. Joined by plain equality, Spark would reuse the shuffle
    of that grouping, and AQE, which splits hot partitions only of shuffles made for a join,
    would leave all rows of a hot key to one task. Null-safe equality is joined on expressions
    of the key instead, so both sides are shuffled for the join; the reduced side is the small
    one. When that side fits a broadcast by its measured size there is no shuffle at all.
    """
    given = rows.filter(quoted(key).isNotNull())
    known = reduced.filter(quoted(reduced_key).isNotNull())
    return given.join(known, quoted(key).eqNullSafe(quoted(reduced_key)), how)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column, list[str]]:
    """``right`` with its keys under names that ``left`` lacks, the condition that keys are equal, and those names."""
    names: list[str] = []
    for i in range(len(keys)):
        names.append(unlike([*left.columns, *right.columns, *names], f"_key{i}"))
    renamed = right.select(
        *[quoted(k).alias(n) for k, n in zip(keys, names)], *[quoted(c) for c in right.columns if c not in keys]
    )
    return renamed, reduce(and_, [quoted(k).eqNullSafe(quoted(n)) for k, n in zip(keys, names)]), names
