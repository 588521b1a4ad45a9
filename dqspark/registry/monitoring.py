"""Monitoring queries over result rows derived from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dqspark.operators.results import preview
from dqspark.plans import monitor as m
from dqspark.registry.inputs import scan_rows, suite_rows

# The events cover 30 days; the range asked for is the last seven.
START, END = "2024-01-23T00:00:00+00:00", "2024-01-30T00:00:00+00:00"


def _naive(df: DataFrame, column: str) -> DataFrame:
    """An instant as its UTC wall time, whatever the zone of the session."""
    return df.withColumn(
        column, F.convert_timezone(None, F.lit("UTC"), F.col(column).cast("timestamp_ntz"))
    )


def _on_scans(query, *args):
    return lambda spark, sf_dir: query(scan_rows(spark, sf_dir), *args)


def _on_suites(query, *args):
    return lambda spark, sf_dir: query(suite_rows(spark, sf_dir), *args)


def _top_failures(spark, sf_dir) -> DataFrame:
    """The five asset columns with most failures."""
    fails = m.fails_per_asset_column(suite_rows(spark, sf_dir))
    return preview(fails, 5, F.desc("total_fails"), F.col("column"), F.col("data_asset_name"))


QUERIES = {
    "mon_top_failures": _top_failures,
    "mon_total_checks": _on_scans(m.total_checks, START, END),
    "mon_pass_rate": _on_scans(m.outcome_rate, "pass", START, END),
    "mon_fail_rate": _on_scans(m.outcome_rate, "fail", START, END),
    "mon_by_table": _on_scans(m.by_table, START, END),
    "mon_fails_over_time": lambda spark, sf_dir: _naive(
        m.fails_over_time(scan_rows(spark, sf_dir), START, END), "check_time"
    ),
    "mon_total_fails_over_time": lambda spark, sf_dir: _naive(
        m.total_fails_over_time(scan_rows(spark, sf_dir)), "datetime_ts"
    ),
    "mon_fails_per_table": _on_scans(m.fails_per_table, START, END),
    "mon_fail_pct_over_time": lambda spark, sf_dir: _naive(
        m.fail_pct_over_time(scan_rows(spark, sf_dir)), "datetime_ts"
    ),
    "mon_by_outcome": _on_scans(m.by_outcome),
    "mon_status": _on_scans(m.status, START, END),
    "mon_fails_per_metric": _on_scans(m.fails_per_metric),
    "mon_success_rate": _on_suites(m.success_rate, START, END),
    "mon_rule_fail_rate": _on_suites(m.fail_rate, START, END),
    "mon_asset_success": _on_suites(m.asset_success, START, END),
    "mon_rule_status": _on_suites(m.rule_status, START, END),
    "mon_fails_per_asset_column": _on_suites(m.fails_per_asset_column, START, END),
}

OUTCOME = "CASE event_type WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'warn' ELSE 'pass' END"

SCANS = f"""WITH scans AS (SELECT 't' || CAST(user_id % 5 AS VARCHAR) AS "table",
 'c' || CAST(user_id % 3 AS VARCHAR) AS "column", event_type AS metric, {OUTCOME} AS outcome,
 strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S+00:00') AS datetime FROM events),
timed AS (SELECT *, strptime(replace(datetime, '+00:00', ''), '%Y-%m-%dT%H:%M:%S') AS t FROM scans),
recent AS (SELECT * FROM timed WHERE t BETWEEN TIMESTAMP '2024-01-23 00:00:00' AND TIMESTAMP '2024-01-30 00:00:00')
"""

SUITES = f"""WITH suites AS (SELECT strftime(ts, '%Y%m%dT%H%M%S.%fZ') AS validation_time,
 't' || CAST(user_id % 5 AS VARCHAR) AS data_asset_name, event_type AS expectation_type,
 'c' || CAST(user_id % 3 AS VARCHAR) AS "column", {OUTCOME} = 'pass' AS success,
 value % 100 AS success_percent FROM events),
recent AS (SELECT * FROM suites WHERE strptime(replace(validation_time, 'Z', ''), '%Y%m%dT%H%M%S.%f')
 BETWEEN TIMESTAMP '2024-01-23 00:00:00' AND TIMESTAMP '2024-01-30 00:00:00')
"""

_SHARE = "CAST(100 AS DOUBLE) * count(*) FILTER (WHERE {0}) / count(*)"

ORACLES = {
    "mon_top_failures": SUITES
    + """SELECT "column", data_asset_name, count(*) AS total_fails FROM suites WHERE NOT success
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5""",
    "mon_total_checks": SCANS + "SELECT count(DISTINCT metric) AS total_unique_checks FROM recent",
    "mon_pass_rate": SCANS + f"""SELECT {_SHARE.format("outcome = 'pass'")} AS pass_percent FROM recent""",
    "mon_fail_rate": SCANS + f"""SELECT {_SHARE.format("outcome = 'fail'")} AS fail_percent FROM recent""",
    "mon_by_table": SCANS
    + """SELECT "table" AS table_source, count(*) FILTER (WHERE outcome = 'pass') AS success_count,
 count(*) FILTER (WHERE outcome = 'fail') AS fail_count FROM recent GROUP BY "table" ORDER BY fail_count DESC, 1""",
    "mon_fails_over_time": SCANS
    + "SELECT t AS check_time, outcome, count(*) AS total_errors FROM recent WHERE outcome = 'fail' GROUP BY ALL ORDER BY 1",
    "mon_total_fails_over_time": SCANS
    + "SELECT t AS datetime_ts, count(*) AS total_fails FROM timed WHERE outcome = 'fail' GROUP BY t ORDER BY t",
    "mon_fails_per_table": SCANS
    + """SELECT "table" AS table_name, outcome, count(*) AS total_checks_fails FROM recent WHERE outcome = 'fail'
GROUP BY "table", outcome ORDER BY 3 DESC, 1""",
    "mon_fail_pct_over_time": SCANS
    + """, counts AS (SELECT t, outcome, count(*) AS total FROM timed GROUP BY t, outcome),
totals AS (SELECT t, sum(total) AS total FROM counts GROUP BY t)
SELECT c.t AS datetime_ts, CAST(100 AS DOUBLE) * c.total / n.total AS fail_percentage
FROM counts c JOIN totals n ON c.t = n.t WHERE c.outcome = 'fail' ORDER BY 1""",
    "mon_by_outcome": SCANS + "SELECT outcome, count(*) AS total FROM scans GROUP BY outcome",
    "mon_status": SCANS + 'SELECT "table", "column", metric, outcome FROM recent',
    "mon_fails_per_metric": SCANS
    + "SELECT metric, count(*) AS total_fails FROM scans WHERE outcome = 'fail' GROUP BY metric ORDER BY 2 DESC, 1",
    "mon_success_rate": SUITES + f"SELECT round({_SHARE.format('success')}, 2) AS success_percent FROM recent",
    "mon_rule_fail_rate": SUITES + f"SELECT round({_SHARE.format('NOT success')}, 2) AS fail_percent FROM recent",
    "mon_asset_success": SUITES
    + """SELECT data_asset_name, round(avg(success_percent), 2) AS mean_success,
 round(CAST(100 AS DOUBLE) - avg(success_percent), 2) AS mean_error FROM recent GROUP BY 1 ORDER BY 2 DESC, 1""",
    "mon_rule_status": SUITES + 'SELECT data_asset_name, "column", expectation_type, success FROM recent',
    "mon_fails_per_asset_column": SUITES
    + """SELECT "column", data_asset_name, count(*) AS total_fails FROM recent WHERE NOT success
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2""",
}
