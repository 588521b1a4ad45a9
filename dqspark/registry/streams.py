"""Results that arrive in files, late and repeated: alerts on changes of state, and panels over a roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqspark.functions.timestamps import parse_ts
from dqspark.plans import panels
from dqspark.registry import monitoring
from dqspark.registry.inputs import scan_rows
from dqspark.session import scratch_path
from dqspark.sources.writers import append_results
from dqspark.streaming.alert_state import alert_changes as start_changes
from dqspark.streaming.rollup import fold_rollup, read_rollup, update_rollup

DELAY_DAYS = 3


#: What each delivery brings: a day held back comes with the second, along with all that the first one had.
_DELIVERIES = (
    "datetime < '2024-01-12' AND NOT datetime BETWEEN '2024-01-10' AND '2024-01-11'",
    "datetime < '2024-01-20'",
    "datetime >= '2024-01-18'",
)

#: The runs that the roll-up takes in: two days come last.
_LATE = "datetime BETWEEN '2024-01-05' AND '2024-01-07'"
_RUNS = (f"datetime < '2024-01-15' AND NOT {_LATE}", "datetime >= '2024-01-15'", _LATE)


def alert_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of state of each table's columns, from three deliveries out of order and with repeats."""
    path, rows = scratch_path(spark, "alert-changes"), scan_rows(spark, sf_dir)
    for delivery in _DELIVERIES:
        append_results(rows.filter(delivery), f"{path}/results")
        start_changes(
            spark,
            f"{path}/results",
            rows.schema,
            f"{path}/changes",
            f"{path}/checkpoint",
            ["table", "column"],
            parse_ts(F.col("datetime")),
            f"{DELAY_DAYS} days",
        ).awaitTermination()
    return monitoring._naive(spark.read.parquet(f"{path}/changes"), "datetime")


def _rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roll-up of three runs' files, the last of which has the oldest results; two are folded before it comes."""
    path, rows = scratch_path(spark, "rollup"), scan_rows(spark, sf_dir)
    for i, run in enumerate(_RUNS):
        append_results(rows.filter(run), f"{path}/results")
        update_rollup(spark, f"{path}/results", rows.schema, f"{path}/rollup", f"{path}/checkpoint").awaitTermination()
        if i == 1:
            fold_rollup(spark, f"{path}/rollup")
    return read_rollup(spark, f"{path}/rollup")


def panel_fails_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = panels.fails_over_time(_rolled_up(spark, sf_dir), monitoring.START, monitoring.END)
    return monitoring._naive(found, "check_time")


def panel_fail_pct_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring._naive(panels.fail_pct_over_time(_rolled_up(spark, sf_dir)), "datetime_ts")


def panel_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.by_table(_rolled_up(spark, sf_dir), monitoring.START, monitoring.END)


QUERIES = {f.__name__: f for f in (alert_changes, panel_fails_over_time, panel_fail_pct_over_time, panel_by_table)}

ORACLES = {
    "alert_changes": monitoring.SCANS
    + f""", states AS (SELECT "table", "column", t, bool_or(outcome = 'fail') AS failed FROM timed GROUP BY ALL),
changes AS (SELECT *, lag(failed, 1, false) OVER (PARTITION BY "table", "column" ORDER BY t) AS before FROM states)
SELECT "table", "column", CASE WHEN failed THEN 'fail' ELSE 'pass' END AS outcome, t AS datetime FROM changes
WHERE failed <> before AND t < (SELECT max(t) FROM timed) - INTERVAL {DELAY_DAYS} DAY""",
    "panel_fails_over_time": monitoring.ORACLES["mon_fails_over_time"],
    "panel_fail_pct_over_time": monitoring.ORACLES["mon_fail_pct_over_time"],
    "panel_by_table": monitoring.ORACLES["mon_by_table"],
}
