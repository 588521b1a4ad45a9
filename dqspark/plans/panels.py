"""Monitoring panels over a roll-up of scan results (``streaming.rollup``): the rows of ``plans.monitor``, from counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dqspark.functions.clean import pct
from dqspark.functions.timestamps import parse_ts, time_filter


def _range(rollup: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return rollup if start is None else time_filter(rollup, "datetime", start, end, "iso")


def _of(outcome: str):
    return F.sum(F.when(F.col("outcome") == outcome, F.col("n")).otherwise(0))


def fails_over_time(rollup: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return (
        _range(rollup, start, end)
        .filter("outcome = 'fail'")
        .groupBy(parse_ts(F.col("datetime")).alias("check_time"), "outcome")
        .agg(F.sum("n").alias("total_errors"))
        .orderBy("check_time")
    )


def fail_pct_over_time(rollup: DataFrame) -> DataFrame:
    """Share of failed rows per run time; run times without a failure do not appear."""
    return (
        rollup.groupBy(parse_ts(F.col("datetime")).alias("datetime_ts"))
        .agg(_of("fail").alias("fails"), F.sum("n").alias("total"))
        .filter("fails > 0 AND datetime_ts IS NOT NULL")
        .select("datetime_ts", pct(F.col("fails"), F.col("total"), None).alias("fail_percentage"))
        .orderBy("datetime_ts")
    )


def by_table(rollup: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return (
        _range(rollup, start, end)
        .groupBy(F.col("table").alias("table_source"))
        .agg(_of("pass").alias("success_count"), _of("fail").alias("fail_count"))
        .orderBy(F.desc("fail_count"), "table_source")
    )


def by_outcome(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("outcome").agg(F.sum("n").alias("total"))
