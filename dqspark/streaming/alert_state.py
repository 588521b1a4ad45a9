"""Alerts on changes: a check that stays failed alerts once, however often and in whatever order its results arrive."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from dqspark.operators.names import quoted

#: Kept per check: whether it was failed when last settled, and the instants not settled yet with their outcome.
_STATE = "failed boolean, instants array<bigint>, fails array<boolean>"


def _once(keys: Sequence[str]):
    """One row per check and instant of each Arrow batch, failed if any was: what a hot check sends to its task."""

    def combine(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby([*keys, "micros"], dropna=False, as_index=False, sort=False)["failed"].max()

    return combine


def _settle(names: list[str]):
    """Per check: join new outcomes to those waiting, and report the changes up to the watermark in order of time."""

    def settle(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        failed, waiting = False, {}
        if state.exists:
            failed, instants, fails = state.get
            waiting = dict(zip(instants, fails))
        if not state.hasTimedOut:
            for batch in batches:
                for instant, bad in zip(batch["micros"].tolist(), batch["failed"].tolist()):
                    waiting[instant] = waiting.get(instant, False) or bool(bad)
        line = state.getCurrentWatermarkMs() * 1000
        changes = []
        for instant in sorted(i for i in waiting if i < line):
            bad = waiting.pop(instant)
            if bad != failed:
                changes.append((*key, "fail" if bad else "pass", instant))
            failed = bad
        left = sorted(waiting)
        state.update((failed, left, [waiting[i] for i in left]))
        if left:
            # The watermark has not passed the first instant that waits; it must pass this one to settle it.
            state.setTimeoutTimestamp(max(left[0] // 1000, line // 1000 + 1))
        yield pd.DataFrame(changes, columns=names)

    return settle


def state_changes(
    results: DataFrame, keys: Sequence[str], time: Column, failed: Column, delay: str = "1 day"
) -> DataFrame:
    """A streaming frame of result rows -> a row per change of a check's state: its keys as text, ``outcome``, ``datetime``.

    ``keys`` tell checks apart; a NULL in them is a value. At an instant a check is failed if any of its results of that
    instant is (``failed``; NULL counts as not). In order of time, each change from good to failed is a row with outcome
    ``fail``, each back one with ``pass``; a check starts as good. An instant counts once the watermark, the largest time
    seen less ``delay``, is past it. So files may come in any order within ``delay`` and any number of times; a result
    that comes later than that is left out, as is one whose time is NULL. The last ``delay`` of results waits for later ones.

    Kept per check are its instants within ``delay``. Rows of a check are combined before they are shuffled.
    """
    for taken in ("datetime", "failed", "outcome", "micros"):
        if taken in keys:
            raise ValueError(f"a key must not be named {taken}")
    given = results.select(
        *[quoted(k).cast("string").alias(k) for k in keys],
        F.unix_micros(time.cast("timestamp")).alias("micros"),
        F.coalesce(failed, F.lit(False)).alias("failed"),
    ).filter("micros IS NOT NULL")
    names, instant = [StructField(k, StringType()) for k in keys], StructField("micros", LongType())
    once = given.mapInPandas(_once(keys), StructType([*names, instant, StructField("failed", BooleanType())]))
    out = StructType([*names, StructField("outcome", StringType()), instant])
    changes = (
        once.withColumn("datetime", F.timestamp_micros("micros"))
        .withWatermark("datetime", delay)
        .groupBy(*[quoted(k) for k in keys])
        .applyInPandasWithState(_settle(out.names), out, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
    return changes.select(*[quoted(k) for k in keys], "outcome", F.timestamp_micros("micros").alias("datetime"))


def alert_changes(
    spark: SparkSession,
    results_path: str,
    schema: StructType,
    out: str,
    checkpoint: str,
    keys: Sequence[str],
    time: Column,
    delay: str = "1 day",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append the changes of state that result files not seen before bring (``state_changes``) to ``out``, then stop.

    ``alerts`` turns those with outcome ``fail`` into messages. The checkpoint holds the states, so a later call goes on
    from there, and a query that died repeats nothing.
    """
    results = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(results_path)
    return (
        state_changes(results, keys, time, F.col("outcome") == "fail", delay)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
