"""Upserts that rewrite only the buckets they touch, and the refresh built on them."""

import os
import random
from pathlib import Path

import pytest
from compare import rows_of
from pyspark.sql import functions as F

from dqspark.operators.dedup import dedup
from dqspark.plans.changes import SALES_BY_USER, refresh_changes
from dqspark.plans.warehouse import KEYS, refresh
from dqspark.registry.inputs import raw_sales
from dqspark.sources import buckets
from dqspark.sources.buckets import bucket_column, read_buckets, read_keys, recover, upsert_buckets
from dqspark.sources.readers import read_table
from dqspark.sources.snapshots import read_snapshot
from dqspark.sources.writers import upsert

SCHEMA = "k long, part string, v long"


def files(path):
    return {p: os.stat(p).st_mtime_ns for p in Path(path).rglob("*.parquet")}


def held(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_increments_equal_a_dictionary_and_rewrite_few_files(spark, tmp_path):
    path, rng, wanted = str(tmp_path / "t"), random.Random(5), {}
    for step in range(4):
        rows = [(rng.choice([None, *range(400)]) if step else i, rng.choice("ab"), step) for i in range(6 if step else 400)]
        before = files(path)
        change = upsert_buckets(spark.createDataFrame(rows, SCHEMA), path, ["k"], [F.desc("part")], buckets=32)
        old = dict(wanted)
        for k, part, v in sorted(rows, key=lambda r: r[1]):  # the last part comes first under the order
            wanted[k] = (part, v)
        assert held(change.table) == sorted(((k, *v) for k, v in wanted.items()), key=str)
        keys = {r[0] for r in rows}
        assert held(change.after) == sorted(((k, *wanted[k]) for k in keys), key=str)
        assert held(change.before) == sorted(((k, *old[k]) for k in keys if k in old), key=str)
        if step:
            touched = {f"bucket_of_32={b}" for b in change.buckets}
            after = files(path)
            same = {p for p in before if after.get(p) == before[p]}
            assert {p.parent.name for p in same} == {p.parent.name for p in before} - touched
            assert {p.parent.name for p in set(after) - same} == touched and len(touched) <= 6
    again = upsert_buckets(spark.createDataFrame([], SCHEMA), path, ["k"])
    assert again.buckets == [] and held(again.table) == held(change.table)
    assert held(read_table(spark, path, "buckets")) == held(change.table)


def test_only_buckets_of_the_keys_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_buckets(spark.range(300).selectExpr("id AS k", "'a' AS part", "id AS v"), path, ["k", "part"], bucket_by=["k"], buckets=16)
    wanted = spark.createDataFrame([(7,), (9,)], "k int")
    found = read_keys(spark, path, wanted, ["k"])
    assert {r.k for r in found.collect()} >= {7, 9}
    assert found.select(F.input_file_name()).distinct().count() <= 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket_of_16" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_failures_leave_or_complete_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert_buckets(spark.range(50).selectExpr("id AS k", "'a' AS part", "id AS v"), path, ["k"], buckets=4)
    before = held(read_buckets(spark, path))
    new = spark.createDataFrame([(3, "b", -3), (99, "b", -99)], SCHEMA)
    with pytest.raises(Exception):
        upsert_buckets(new.withColumn("v", F.raise_error(F.lit("bad row")).cast("long")), path, ["k"])
    assert held(read_buckets(spark, path)) == before

    def dies(spark, path):  # before folders are replaced
        if (Path(path) / "_pending" / "_SUCCESS").exists():
            raise RuntimeError("driver lost")
        return recover(spark, path)

    with monkeypatch.context() as m:
        m.setattr(buckets, "recover", dies)
        with pytest.raises(RuntimeError):
            upsert_buckets(new, path, ["k"])
    assert held(read_buckets(spark, path)) == before
    # A folder was taken away, and the new one not put in place: the pending write still has it.
    gone = next((Path(path) / "_pending").glob("bucket_of_4=*")).name
    for file in (Path(path) / gone).iterdir():
        file.unlink()
    recover(spark, path)
    recover(spark, path)
    wanted = {r[0]: r for r in before} | {3: (3, "b", -3), 99: (99, "b", -99)}
    assert held(read_buckets(spark, path)) == sorted(wanted.values(), key=str)


@pytest.mark.parametrize("form", ["buckets", "snapshot"])
def test_columns_and_keys(spark, tmp_path, form):
    path = str(tmp_path / "t")

    def put(rows, schema, **more):
        df = spark.createDataFrame(rows, schema)
        if form == "buckets":
            return upsert_buckets(df, path, ["k"], **more).table
        return upsert(df, path, ["k"], **more)

    put([(1, "a", 1, 5), (2, "b", 2, 6)], "k long, _rank string, _0 long, _key0 long")
    table = put([(2, "c"), (3, "d")], "k int, _rank string")  # stored values stay, NULL in new rows
    assert held(table) == [(1, "a", 1, 5), (2, "c", 2, 6), (3, "d", None, None)]
    with pytest.raises(ValueError, match="no column more"):
        put([(2, "c", 1)], "k long, _rank string, more long")
    with pytest.raises(ValueError, match="key k is string"):
        put([("2", "c")], "k string, _rank string")
    table = put([(2, 7)], "k long, more long", add_columns=True)
    assert held(table.select("k", "more")) == [(1, None), (2, 7), (3, None)]
    assert held(table.filter("k = 2").drop("more")) == [(2, "c", 2, 6)]


def test_first_load_without_rows_and_wrong_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    assert upsert_buckets(spark.createDataFrame([], SCHEMA), path, ["k"]).buckets == []
    assert bucket_column(spark, path) is None
    with pytest.raises(FileNotFoundError):
        read_buckets(spark, path)
    with pytest.raises(ValueError):
        upsert_buckets(spark.createDataFrame([], SCHEMA), path, ["k"], bucket_by=["v"])


def test_dedup_keeps_a_column_named_rank(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2)], "`k.k` long, _rank string, _rank_ long")
    assert held(dedup(df, ["k.k"])) == [(1, "a", 2)]


def test_changes_equal_full_refreshes(spark, sf_dir, tmp_path):
    """Three increments in which products change users, prices and ratings, with NULL keys."""
    raw = raw_sales(spark, sf_dir)
    part = F.pmod(F.xxhash64("review_id"), F.lit(20))
    raw = raw.withColumn("product_id", F.when(F.pmod(F.xxhash64("review_id"), F.lit(50)) != 7, F.col("product_id")))
    raw = raw.withColumn("user_id", F.when(F.pmod(F.xxhash64("review_id"), F.lit(31)) != 7, F.col("user_id")))
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    increments = [raw.filter(part < 8), raw.filter(part == 8).withColumn("actual_price", F.lit("₹12.50")), raw.filter(part == 9)]
    for increment in increments:
        before = files(tmp_path / "b")
        a = refresh(spark, increment, str(tmp_path / "a"))
        b = refresh_changes(spark, increment, str(tmp_path / "b"), buckets=16)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        for name in KEYS:
            x, y = read_snapshot(spark, f"{tmp_path}/a/{name}"), read_buckets(spark, f"{tmp_path}/b/{name}")
            assert rows_of(x.columns, x.collect()) == rows_of(y.columns, y.collect()), name
    small = raw.filter(part == 10).limit(1)
    before = files(tmp_path / "b")
    refresh_changes(spark, small, str(tmp_path / "b"), check=False)
    after, tables = files(tmp_path / "b"), [*KEYS, SALES_BY_USER]
    for name in tables:  # one product: its users' buckets at most
        left = {p for p in before if name in p.parts and after.get(p) == before[p]}
        assert len({p.parent for p in left}) >= len({p.parent for p in before if name in p.parts}) - 2
    empty = refresh_changes(spark, raw.limit(0), str(tmp_path / "b"), check=False)
    assert empty.count() == 0 and {p: t for p, t in files(tmp_path / "b").items() if "dq_results" not in p.parts} == {
        p: t for p, t in after.items() if "dq_results" not in p.parts
    }
