import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dqspark.operators.dedup import dedup
from dqspark.operators.violations import duplicated_rows, orphans
from dqspark.session import SHARED, clear_scratch, scratch_path, shared_dir, stored
from dqspark.sources.readers import (
    jdbc_options,
    load_tables,
    read_csv,
    read_table,
    register,
    register_results,
)
from dqspark.sources.snapshots import read_snapshot, snapshots, write_snapshot
from dqspark.sources.writers import (
    append_results,
    ensure_namespace,
    ensure_table,
    insert_overwrite,
    materialize,
    upsert,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def table(spark, *values):
    return spark.createDataFrame(list(values), "k int, v string")


def test_upsert_replaces_and_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(table(spark, (1, "a"), (2, "b")), path, ["k"])
    upsert(table(spark, (2, "B"), (3, "c")), path, ["k"])
    assert rows(read_snapshot(spark, path)) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_again_changes_nothing(spark, tmp_path):
    path, source = str(tmp_path / "t"), table(spark, (1, "a"), (2, "b"))
    upsert(source, path, ["k"])
    upsert(source, path, ["k"])
    assert rows(read_snapshot(spark, path)) == [(1, "a"), (2, "b")]


def test_upsert_reduces_the_source_to_its_first_row(spark, tmp_path):
    path = str(tmp_path / "t")
    source = table(spark, (1, "a"), (1, "z"), (1, "m"))
    upsert(source, path, ["k"], [F.desc("v")])
    assert rows(read_snapshot(spark, path)) == [(1, "z")]
    upsert(source, path, ["k"])
    assert rows(read_snapshot(spark, path)) == [(1, "a")]


def test_upsert_null_key_is_a_key(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(table(spark, (None, "a")), path, ["k"])
    upsert(table(spark, (None, "b")), path, ["k"])
    assert rows(read_snapshot(spark, path)) == [(None, "b")]


def test_upsert_takes_columns_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(table(spark, (1, "a")), path, ["k"])
    upsert(table(spark, (1, "b")).select("v", "k"), path, ["k"])
    assert read_snapshot(spark, path).columns == ["k", "v"]
    assert rows(read_snapshot(spark, path)) == [(1, "b")]


def test_a_write_that_died_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(table(spark, (1, "a")), path, ["k"])
    table(spark, (9, "half")).write.parquet(f"{path}/snapshot-00000002")
    os.remove(f"{path}/snapshot-00000002/_SUCCESS")
    assert rows(read_snapshot(spark, path)) == [(1, "a")]
    upsert(table(spark, (2, "b")), path, ["k"])
    assert snapshots(spark, path)[-1].endswith("snapshot-00000003")
    assert rows(read_snapshot(spark, path)) == [(1, "a"), (2, "b")]


def test_old_snapshots_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        write_snapshot(table(spark, (i, "x")), path, keep=2)
    assert [s[-1] for s in snapshots(spark, path)] == ["3", "4"]


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, str(tmp_path / "none"))


def test_merge_needs_a_table_that_can(spark):
    materialize(table(spark, (1, "a")), "plain_parquet")
    with pytest.raises(Exception, match="MERGE|TABLE_OPERATION|not support"):
        upsert(table(spark, (1, "b")), "plain_parquet", ["k"], catalog=True)


def test_catalog_upsert_makes_its_table(spark, tmp_path):
    ensure_namespace(spark, "fresh", str(tmp_path))
    assert rows(upsert(table(spark, (1, "a"), (1, "b")), "fresh.made", ["k"], catalog=True)) == [(1, "a")]
    spark.sql("DROP TABLE fresh.made")


def test_new_columns_are_not_dropped(spark, tmp_path):
    path, wider = str(tmp_path / "t"), table(spark, (2, "b")).withColumn("z", F.lit(7))
    upsert(table(spark, (1, "a")), path, ["k"])
    with pytest.raises(ValueError, match="no column z"):
        upsert(wider, path, ["k"])
    assert rows(upsert(wider, path, ["k"], add_columns=True)) == [(1, "a", None), (2, "b", 7)]
    materialize(table(spark, (1, "a")), "narrow")
    with pytest.raises(ValueError, match="no column z"):
        insert_overwrite(wider, "narrow")


def test_text_keys_against_numbers(spark):
    child = spark.createDataFrame([("1",), (" 2 ",), ("x",), (None,), ("9",)], "k string")
    parent = spark.createDataFrame([(1.0,), (2.0,), (2.0,)], "p double")
    assert rows(orphans(child, "k", parent, "p")) == [("9",), ("x",)]
    assert rows(orphans(parent, "p", child, "k")) == []


def test_catalog_writes(spark):
    ensure_namespace(spark, "test_ns")
    ensure_table(table(spark, (1, "a")), "test_ns.t")
    assert spark.table("test_ns.t").count() == 0
    ensure_table(table(spark, (1, "a")), "test_ns.t")
    insert_overwrite(table(spark, (1, "a"), (2, "b")).select("v", "k"), "test_ns.t")
    insert_overwrite(table(spark, (3, "c")), "test_ns.t")
    assert rows(spark.table("test_ns.t")) == [(3, "c")]
    with pytest.raises(AnalysisException):
        insert_overwrite(spark.table("test_ns.t"), "test_ns.t")


def test_csv_text_and_line_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('k,v\n1,"a ""q"", b"\n2,"two\nlines"\n')
    assert read_csv(spark, str(path)).dtypes == [("k", "string"), ("v", "string")]
    assert rows(read_csv(spark, str(path), multi_line=True)) == [("1", 'a "q", b'), ("2", "two\nlines")]
    assert rows(read_csv(spark, str(path), "k int, v string", multi_line=True))[0] == (1, 'a "q", b')


def test_load_several_and_register(spark, tmp_path):
    for name in ("a", "b"):
        table(spark, (1, name)).write.parquet(str(tmp_path / name))
    loaded = load_tables(spark, str(tmp_path), ["a", "b"])
    assert rows(loaded["b"]) == [(1, "b")]
    register(read_table(spark, str(tmp_path / "a")), "some_view")
    assert rows(spark.sql("SELECT * FROM some_view")) == [(1, "a")]


def test_result_folders_become_tables(spark, tmp_path):
    results = spark.createDataFrame([("x", 1), ("y", 2)], "context string, n int")
    append_results(results, str(tmp_path / "runs"), "context")
    append_results(results.filter("n = 1"), str(tmp_path / "plain"))
    assert register_results(spark, str(tmp_path), "dqt_") == ["dqt_plain", "dqt_runs"]
    assert spark.table("dqt_runs").count() == 2
    append_results(results, str(tmp_path / "plain"))
    register_results(spark, str(tmp_path), "dqt_")
    assert spark.table("dqt_plain").count() == 3


def test_jdbc_reads_are_split():
    options = jdbc_options("jdbc:x", "sales.dim_user", "id", (1, 1000), 16, {"user": "me"})
    assert options["numPartitions"] == "16" and options["upperBound"] == "1000" and options["user"] == "me"
    assert "partitionColumn" not in jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id")


def test_scratch_is_below_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_without_a_setting():
    class Session:
        """A session of which only its settings are asked."""

        class conf:
            settings = {}
            get = staticmethod(lambda key, default: Session.conf.settings.get(key, default))

    with pytest.raises(ValueError):
        shared_dir(Session)
    Session.conf.settings[SHARED] = "/own/"
    assert shared_dir(Session) == "/own"
    Session.conf.settings["spark.checkpoint.dir"] = "/of/the/cluster"
    assert shared_dir(Session) == "/of/the/cluster"


def test_scratch_can_be_cleared(spark):
    df = stored(table(spark, (1, "a")), "x")
    (path,) = {f.rsplit("/", 1)[0].removeprefix("file:") for f in df.inputFiles()}
    path = path.removeprefix("//")
    assert os.path.exists(path)
    clear_scratch(spark)
    assert not os.path.exists(path)


def test_dedup_without_order_is_still_determined(spark):
    df = table(spark, (1, "b"), (1, "a"), (2, None), (2, "c"))
    assert sorted(map(str, dedup(df, ["k"]).collect())) == ["Row(k=1, v='a')", "Row(k=2, v='c')"]


def test_orphans_and_duplicates(spark):
    child = table(spark, (1, "x"), (1, "x"), (2, None), (3, "y"), (None, None), (None, None))
    parent = spark.createDataFrame([("x",), ("x",)], "name string")
    assert rows(orphans(child, "v", parent, "name")) == [(3, "y")]
    assert rows(duplicated_rows(child, ["k", "v"])) == [(1, "x"), (1, "x")]
