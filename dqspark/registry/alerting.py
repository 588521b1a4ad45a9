"""Alerts from result rows, in a batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqspark.registry.monitoring import SCANS
from dqspark.session import scratch_path
from dqspark.registry.inputs import scan_rows
from dqspark.sources.writers import append_results
from dqspark.streaming import alerts as a

ORIGIN, PIPELINE = "Data Quality", "sales"


def _validation():
    return F.concat_ws(".", "table", "column", "metric")


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.alerts(scan_rows(spark, sf_dir), ORIGIN, PIPELINE, _validation(), F.col("datetime"))


def alert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of alerts; every message whose check is on column c0 has lost its details."""
    rows = scan_rows(spark, sf_dir)
    details = F.when(F.col("column") != "c0", F.col("datetime"))
    return a.alert_text(a.alerts(rows, ORIGIN, PIPELINE, _validation(), details))


def warning_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    warnings = scan_rows(spark, sf_dir).filter("outcome = 'warn'")
    return a.warning_digest(warnings, "datetime", _validation(), F.col("outcome"))


def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results arrive as files in two runs; a query started after each turns the new ones into alerts."""
    path = scratch_path(spark, "alerts")
    rows = scan_rows(spark, sf_dir)

    def drain() -> None:
        a.alert_stream(
            spark,
            f"{path}/results",
            rows.schema,
            f"{path}/alerts",
            f"{path}/checkpoint",
            ORIGIN,
            PIPELINE,
            _validation(),
            F.col("datetime"),
        ).awaitTermination()

    for run in (F.col("datetime") < "2024-01-15", F.col("datetime") >= "2024-01-15"):
        append_results(rows.filter(run), f"{path}/results")
        drain()
    return spark.read.parquet(f"{path}/alerts")


QUERIES = {f.__name__: f for f in (alerts, alert_text, warning_digest, alert_stream)}

_NAME = """"table" || '.' || "column" || '.' || metric"""

_ALERTS = (
    SCANS
    + f"""SELECT '{ORIGIN}' AS origin, '{PIPELINE}' AS pipeline, {_NAME} AS validation, datetime AS details,
 '{{"origem":"{ORIGIN}","pipeline":"{PIPELINE}","validacao":"' || {_NAME} || '","detalhes":"' || datetime || '"}}' AS message
FROM scans WHERE outcome = 'fail'"""
)

ORACLES = {
    "alerts": _ALERTS,
    "alert_stream": _ALERTS,
    "alert_text": SCANS
    + f"""SELECT '{{"origem":"{ORIGIN}","pipeline":"{PIPELINE}","validacao":"' || {_NAME} || '"' ||
 CASE WHEN "column" = 'c0' THEN '' ELSE ',"detalhes":"' || datetime || '"' END || '}}' AS message,
 '📢 **Data Quality Alert**:' || chr(10) || '**Origem**: {ORIGIN}' || chr(10) || '**Pipeline**: {PIPELINE}' || chr(10) ||
 '**Validação**: ' || {_NAME} || chr(10) || '**Detalhes**: ' ||
 CASE WHEN "column" = 'c0' THEN 'Desconhecido' ELSE datetime END AS text
FROM scans WHERE outcome = 'fail'""",
    "warning_digest": SCANS
    + f"""SELECT datetime, string_agg(line, chr(10) ORDER BY line) AS digest, CAST(sum(n) AS BIGINT) AS warnings FROM (
 SELECT datetime, 'Test: ' || {_NAME} || ' | Result: ' || outcome || ' | Count: ' || CAST(count(*) AS VARCHAR) AS line,
 count(*) AS n FROM scans WHERE outcome = 'warn' GROUP BY datetime, "table", "column", metric, outcome)
GROUP BY datetime""",
}
