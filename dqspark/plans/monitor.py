"""Monitoring queries over the two result tables.

``scans`` has the columns of ``scan_results``, its time is ISO text; ``suites`` those of
``suite_results``, its time is compact text. The range is given as two ISO instants. Outcomes
are counted conditionally in the one grouping a query needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dqspark.functions.clean import pct
from dqspark.functions.timestamps import parse_ts, time_filter


def _scans(scans: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return scans if start is None else time_filter(scans, "datetime", start, end, "iso")


def _suites(suites: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return suites if start is None else time_filter(suites, "validation_time", start, end, "compact")


def _count():
    return F.count(F.lit(1))


def total_checks(scans: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return _scans(scans, start, end).agg(F.count_distinct("metric").alias("total_unique_checks"))


def outcome_rate(
    scans: DataFrame, outcome: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Share of rows with this outcome, in percent."""
    return _scans(scans, start, end).agg(
        pct(F.count_if(F.col("outcome") == outcome), _count(), None).alias(f"{outcome}_percent")
    )


def by_table(scans: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return (
        _scans(scans, start, end)
        .groupBy(F.col("table").alias("table_source"))
        .agg(
            F.count_if(F.col("outcome") == "pass").alias("success_count"),
            F.count_if(F.col("outcome") == "fail").alias("fail_count"),
        )
        .orderBy(F.desc("fail_count"), "table_source")
    )


def fails_over_time(scans: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return (
        _scans(scans, start, end)
        .filter(F.col("outcome").isin("fail"))
        .groupBy(parse_ts(F.col("datetime")).alias("check_time"), "outcome")
        .agg(_count().alias("total_errors"))
        .orderBy("check_time")
    )


def fails_per_table(scans: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return (
        _scans(scans, start, end)
        .filter(F.col("outcome") == "fail")
        .groupBy(F.col("table").alias("table_name"), "outcome")
        .agg(_count().alias("total_checks_fails"))
        .orderBy(F.desc("total_checks_fails"), "table_name")
    )


def fail_pct_over_time(scans: DataFrame) -> DataFrame:
    """Share of failed rows per run time; run times without a failure do not appear."""
    fails = F.count_if(F.col("outcome") == "fail")
    return (
        scans.groupBy(parse_ts(F.col("datetime")).alias("datetime_ts"))
        .agg(fails.alias("fails"), _count().alias("total"))
        .filter("fails > 0 AND datetime_ts IS NOT NULL")
        .select("datetime_ts", pct(F.col("fails"), F.col("total"), None).alias("fail_percentage"))
        .orderBy("datetime_ts")
    )


def by_outcome(scans: DataFrame) -> DataFrame:
    return scans.groupBy("outcome").agg(_count().alias("total"))


def status(scans: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return _scans(scans, start, end).select("table", "column", "metric", "outcome")


def fails_per_metric(scans: DataFrame) -> DataFrame:
    return (
        scans.filter(F.col("outcome") == "fail")
        .groupBy("metric")
        .agg(_count().alias("total_fails"))
        .orderBy(F.desc("total_fails"), "metric")
    )


def total_fails_over_time(scans: DataFrame) -> DataFrame:
    return (
        scans.filter(F.col("outcome") == "fail")
        .groupBy(parse_ts(F.col("datetime")).alias("datetime_ts"))
        .agg(_count().alias("total_fails"))
        .orderBy("datetime_ts")
    )


def success_rate(suites: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return _suites(suites, start, end).agg(pct(F.count_if("success"), _count()).alias("success_percent"))


def fail_rate(suites: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return _suites(suites, start, end).agg(pct(F.count_if(~F.col("success")), _count()).alias("fail_percent"))


def asset_success(suites: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    mean = F.avg("success_percent")
    return (
        _suites(suites, start, end)
        .groupBy("data_asset_name")
        .agg(F.round(mean, 2).alias("mean_success"), F.round(F.lit(100.0) - mean, 2).alias("mean_error"))
        .orderBy(F.desc("mean_success"), "data_asset_name")
    )


def rule_status(suites: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return _suites(suites, start, end).select("data_asset_name", "column", "expectation_type", "success")


def fails_per_asset_column(suites: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return (
        _suites(suites, start, end)
        .filter(~F.col("success"))
        .groupBy("column", "data_asset_name")
        .agg(_count().alias("total_fails"))
        .orderBy(F.desc("total_fails"), "column", "data_asset_name")
    )
