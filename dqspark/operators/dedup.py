"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dqspark.operators.names import quoted, unlike


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()) -> DataFrame:
    """Keep the first row of every key under ``order_by``.

    All other columns, in order of name, break ties, a value before NULL, so the survivor does not
    depend on the layout of the data. Spark keeps only the first row per key of each input partition before
    the shuffle (WindowGroupLimit), hence a key holding much of the table is no hot spot.
    """
    rest = [quoted(c).asc_nulls_last() for c in sorted(df.columns) if c not in keys]
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*(list(order_by) + rest or [F.lit(1)]))
    rank = unlike(df.columns, "_rank")
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)
