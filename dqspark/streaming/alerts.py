"""Alert rows for failed checks. Sending them is left to whoever reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dqspark.functions.clean import default_text

# The keys of an alert message, and the text form of an alert.
MESSAGE_KEYS = {"origin": "origem", "pipeline": "pipeline", "validation": "validacao", "details": "detalhes"}
UNKNOWN = "Desconhecido"
TEXT = (
    "📢 **Data Quality Alert**:\n**Origem**: %s\n**Pipeline**: %s\n**Validação**: %s\n**Detalhes**: %s"
)


def failed(results: DataFrame) -> DataFrame:
    return results.filter(F.col("outcome") == "fail")


def alerts(results: DataFrame, origin: str, pipeline: str, validation: Column, details: Column) -> DataFrame:
    """Four text columns and the same as a JSON message, a row per failed check."""
    rows = failed(results).select(
        F.lit(origin).alias("origin"),
        F.lit(pipeline).alias("pipeline"),
        validation.cast("string").alias("validation"),
        details.cast("string").alias("details"),
    )
    message = F.to_json(F.struct(*[F.col(ours).alias(key) for ours, key in MESSAGE_KEYS.items()]))
    return rows.withColumn("message", message)


def alert_text(messages: DataFrame) -> DataFrame:
    """The text of each alert, from its JSON message; a key that is missing shows as unknown."""
    body = F.from_json("message", StructType.fromDDL(", ".join(f"{k} string" for k in MESSAGE_KEYS.values())))
    shown = [default_text(F.col(f"_body.{key}"), UNKNOWN) for key in MESSAGE_KEYS.values()]
    return messages.withColumn("_body", body).select("message", F.format_string(TEXT, *shown).alias("text"))


def warning_digest(results: DataFrame, run: str, test: Column, result: Column) -> DataFrame:
    """One text per run that lists its tests with their results, in order of name.

    Equal lines are counted first, so what is gathered per run is one line per test of the
    suite, however many rows report it.
    """
    lines = (
        results.select(F.col(run), test.alias("test"), result.alias("result"))
        .groupBy(run, "test", "result")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    line = F.format_string("Test: %s | Result: %s | Count: %d", "test", "result", "n")
    return lines.groupBy(run).agg(
        F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("digest"),
        F.sum("n").alias("warnings"),
    )


def alert_stream(
    spark: SparkSession,
    results_path: str,
    schema: StructType,
    out: str,
    checkpoint: str,
    origin: str,
    pipeline: str,
    validation: Column,
    details: Column,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Turn result files not seen before into alert rows, then stop.

    The checkpoint makes each file count once, also if the query dies and is started again.
    The operators are those of ``alerts``; nothing is kept between batches.
    """
    results = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(results_path)
    return (
        alerts(results, origin, pipeline, validation, details)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
