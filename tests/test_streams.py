"""Alerts on changes of state, and roll-ups, from files that come late, out of order and twice."""

import random

import pytest
from pyspark.sql import functions as F

from dqspark.functions.timestamps import parse_ts
from dqspark.plans import monitor, panels
from dqspark.sources.files import child_folders
from dqspark.streaming.alert_state import alert_changes
from dqspark.streaming.rollup import counted, fold_rollup, read_rollup, update_rollup

SCHEMA = "`table` string, `column` string, metric string, outcome string, datetime string"


def at(hour):
    return f"2024-01-{1 + hour // 24:02d}T{hour % 24:02d}:00:00+00:00"


def changes_of(rows, before):
    """Plain Python: changes of each check in order of its hours below ``before``."""
    states = {}
    for table, column, _, outcome, time in rows:
        hours = states.setdefault((table, column), {})
        hours[time] = hours.get(time, False) or outcome == "fail"
    found = set()
    for key, hours in states.items():
        failed = False
        for time in sorted(t for t in hours if t < before):
            if hours[time] != failed:
                found.add((*key, "fail" if hours[time] else "pass", time))
            failed = hours[time]
    return found


@pytest.fixture
def folders(tmp_path):
    return {name: str(tmp_path / name) for name in ("results", "out", "checkpoint")}


def test_changes_of_state(spark, folders):
    """Random results of 200 hours in shuffled blocks of ten hours, each delivered twice, a check without a name among them."""
    rng = random.Random(3)
    rows = [
        (rng.choice(["t1", "t2", None]), rng.choice(["a", "b"]), "m", rng.choice(["pass", "warn", "fail", None]), at(h))
        for h in range(200)
        for _ in range(4)
    ]
    bad_time = [("t1", "a", "m", "fail", "not a time")]
    blocks = [rows[i : i + 40] for i in range(0, 800, 40)]
    schema = spark.createDataFrame([], SCHEMA).schema
    deliveries = [(0, 2, 1), (4, 3, 1, 2), tuple(range(20))]
    for delivery in deliveries:
        sent = [r for i in delivery for r in blocks[i]] + bad_time
        rng.shuffle(sent)
        spark.createDataFrame(sent, schema).repartition(3).write.mode("append").parquet(folders["results"])
        alert_changes(
            spark, folders["results"], schema, folders["out"], folders["checkpoint"],
            ["table", "column"], parse_ts(F.col("datetime")), "30 hours",
        ).awaitTermination()
    found = spark.read.parquet(folders["out"]).withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ssXXX"))
    found = [(r["table"], r["column"], r.outcome, r.datetime.replace("Z", "+00:00")) for r in found.collect()]
    assert len(found) == len(set(found)) and set(found) == changes_of(rows, at(199 - 30))


def test_a_check_that_stays_failed_alerts_once(spark, folders):
    schema = spark.createDataFrame([], SCHEMA).schema
    for first in (0, 10, 20):
        rows = [("t", "c", "m", "fail", at(h)) for h in range(first, first + 10)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folders["results"])
        alert_changes(
            spark, folders["results"], schema, folders["out"], folders["checkpoint"],
            ["table"], parse_ts(F.col("datetime")), "2 hours",
        ).awaitTermination()
    assert [r.outcome for r in spark.read.parquet(folders["out"]).collect()] == ["fail"]


def test_changes_of_no_results(spark, folders):
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.parquet(folders["results"])
    alert_changes(
        spark, folders["results"], empty.schema, folders["out"], folders["checkpoint"], ["table"], parse_ts(F.col("datetime"))
    ).awaitTermination()
    assert spark.read.schema("`table` string, outcome string, datetime timestamp").parquet(folders["out"]).count() == 0
    with pytest.raises(ValueError):
        alert_changes(
            spark, folders["results"], empty.schema, folders["out"], folders["checkpoint"], ["outcome"], F.col("datetime")
        )


def test_rollup_counts_every_file_once(spark, folders):
    rng = random.Random(4)
    schema = spark.createDataFrame([], SCHEMA).schema

    def deliver(hours):
        rows = [(rng.choice(["t", None]), "c", "m", rng.choice(["fail", "pass"]), at(rng.choice(hours))) for _ in range(60)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folders["results"])

    def update():
        update_rollup(spark, folders["results"], schema, folders["out"], folders["checkpoint"]).awaitTermination()

    def rows_of(df):
        return sorted(map(str, df.select("datetime", "table", "outcome", "n").collect()))

    for i, hours in enumerate([range(50, 60), range(60, 70), range(0, 55)]):
        deliver(hours)
        update()
        update()
        if i != 1:
            fold_rollup(spark, folders["out"])
            fold_rollup(spark, folders["out"])
        results = spark.read.parquet(folders["results"])
        rollup = read_rollup(spark, folders["out"])
        assert rows_of(rollup) == rows_of(counted(results))
        for panel in ("fails_over_time", "fail_pct_over_time", "by_table"):
            assert getattr(panels, panel)(rollup).collect() == getattr(monitor, panel)(results).collect()
        assert sorted(panels.by_outcome(rollup).collect()) == sorted(monitor.by_outcome(results).collect())
    assert len([f for f in child_folders(spark, folders["out"]) if "part=" in f]) == 0
    with pytest.raises(FileNotFoundError):
        read_rollup(spark, folders["out"] + "-none")


def test_a_batch_run_again_counts_once(spark, folders):
    """A query that died after its write and before its commit: the batch's commit is taken back."""
    import pathlib

    schema = spark.createDataFrame([], SCHEMA).schema
    for hour in (1, 2):
        spark.createDataFrame([("t", "c", "m", "fail", at(hour))], schema).write.mode("append").parquet(folders["results"])
        update_rollup(spark, folders["results"], schema, folders["out"], folders["checkpoint"]).awaitTermination()
    commits = pathlib.Path(folders["checkpoint"]) / "commits"
    for file in (commits / "1", commits / ".1.crc"):
        file.unlink(missing_ok=True)
    update_rollup(spark, folders["results"], schema, folders["out"], folders["checkpoint"]).awaitTermination()
    assert read_rollup(spark, folders["out"]).agg(F.sum("n")).first()[0] == 2


def test_panels_do_not_scan_results(spark, folders):
    schema = spark.createDataFrame([], SCHEMA).schema
    spark.createDataFrame([("t", "c", "m", "fail", at(1))], schema).write.parquet(folders["results"])
    update_rollup(spark, folders["results"], schema, folders["out"], folders["checkpoint"]).awaitTermination()
    files = panels.fail_pct_over_time(read_rollup(spark, folders["out"])).inputFiles()
    assert files and all("/out/part=0/" in f for f in files)
