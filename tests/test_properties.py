"""Upserts and dedup against a dictionary, on random tables."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from dqspark.operators.dedup import dedup
from dqspark.sources.snapshots import read_snapshot
from dqspark.sources.writers import upsert

KEY = st.sampled_from([None, "a", "b", "c", "hot", "hot", "hot"])
ROWS = st.lists(st.tuples(KEY, st.integers(0, 3), st.sampled_from([None, "x", "y"])), max_size=12)
SLOW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)


def first_rows(rows):
    """The survivor of each key: largest n, then the smallest text, NULL after all."""
    best = {}
    for k, n, v in sorted(rows, key=lambda row: (-row[1], row[2] is None, row[2] or "")):
        best.setdefault(k, (k, n, v))
    return best


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, v string").repartition(3)


def as_rows(df):
    return {tuple(row) for row in df.collect()}


@SLOW
@given(rows=ROWS)
def test_dedup(spark, rows):
    found = dedup(frame(spark, rows), ["k"], [F.desc("n")])
    assert found.count() == len(first_rows(rows))
    assert as_rows(found) == set(first_rows(rows).values())


@SLOW
@given(batches=st.lists(ROWS, min_size=1, max_size=3))
def test_upserts(spark, tmp_path_factory, batches):
    folder, expected = tmp_path_factory.mktemp("upserts"), {}
    for rows in batches:
        upsert(frame(spark, rows), f"{folder}/t", ["k"], [F.desc("n")])
        expected |= first_rows(rows)
    assert as_rows(read_snapshot(spark, f"{folder}/t")) == set(expected.values())
