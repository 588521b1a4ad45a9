"""One bad row, rule, file or key does not take the others with it."""

import pytest
from pyspark.sql import functions as F

from dqspark.operators.evaluate import evaluate, failing_rows
from dqspark.operators.failing import rows_breaking, tagged_rows
from dqspark.operators.rules import (
    between,
    compound_unique,
    invalid,
    matches,
    missing,
    not_null,
    references,
    row_count,
    unique,
    uniqueness,
)
from dqspark.operators.violations import duplicated_rows, orphans, repeated_keys
from dqspark.sources.readers import read_csv, read_csv_checked, register_results


def held(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i % 7 or None, f"n{i % 5}", float(i), f"t{i}" if i % 4 else None, i % 3) for i in range(60)]
    rows += [(None, None, None, None, None)] * 2
    names = ["Id", "a.b", "v", "text", "_breaks3"]
    return spark.createDataFrame(rows, "Id long, `a.b` string, v double, text string, _breaks3 int").toDF(*names)


def test_tagged_rows_equal_the_rows_of_each_rule(spark, table):
    parents = spark.createDataFrame([(k,) for k in (1, 2, 3)], "k long")
    rules = [
        between("v", 10, 40),
        not_null("id"),
        unique("text"),
        compound_unique(["Id", "a.b"]),
        references("ID", "parents", "k"),
        matches("a.b", "^n[0-3]$", mostly=0.5),
        invalid("text", regex="^t"),
        missing("a.b", must="< 5"),
        row_count("> 3"),
        uniqueness("a.b", must="> 0.5"),
        not_null("no_such"),
        references("Id", "nowhere", "k"),
    ]
    tagged = tagged_rows(table, rules, {"parents": parents})
    assert tagged.columns == [*table.columns, "broken"]
    for position, rule in enumerate(rules, start=1):
        mine = rows_breaking(tagged, position)
        if position in (9, 10, 11, 12):
            assert mine.isEmpty()
            continue
        wanted = failing_rows(table, rule, {"parents": parents})
        assert held(mine) == held(wanted.select(*[F.col(f"`{c}`") for c in table.columns])), rule
    assert tagged_rows(table.limit(0), rules, {"parents": parents}).isEmpty()
    assert tagged_rows(table, []).isEmpty()
    with pytest.raises(ValueError):
        tagged_rows(table, rules, column="V")


def test_one_scan_tags_all_rules_on_values(table):
    plan = tagged_rows(table, [between("v", 1, 2), not_null("Id"), matches("a.b", "x")])._jdf.queryExecution()
    assert "Exchange" not in plan.executedPlan().toString() and "Join" not in plan.executedPlan().toString()


@pytest.mark.parametrize("bits", [64, 8, 1])
def test_repeated_keys_are_exact_though_hashes_collide(spark, bits):
    rows = [(i % 90, "a" if i % 2 else None) for i in range(100)] + [(None, None)] * 3 + [(None, "b")] * 2
    df = spark.createDataFrame(rows, "`k.k` long, _hash string")
    wanted = sorted({str(r) for r in rows if rows.count(r) > 1 and r != (None, None)})
    assert sorted(str(tuple(r)) for r in repeated_keys(df, ["k.k", "_hash"], bits).collect()) == wanted
    assert duplicated_rows(df, ["k.k", "_hash"]).count() == sum(rows.count(r) > 1 and r != (None, None) for r in rows)


def test_text_keys_meet_dates(spark):
    parent = spark.createDataFrame([("2024-01-01",), (None,)], "d string").select(F.to_date("d").alias("d"))
    child = spark.createDataFrame([("2024-01-01", 1), (" 2024-01-01 ", 2), ("dirt", 3), ("2024-01-02", 4), (None, 5)], "_fk string, _pk int")
    assert [r["_pk"] for r in orphans(child, "_fk", parent, "d").orderBy("_pk").collect()] == [3, 4]
    assert orphans(parent, "d", child, "_fk").count() == 0
    (found,) = evaluate(child, [references("_fk", "p", "d")], tables={"p": parent}).collect()
    assert (found.unexpected_count, found.outcome) == (2, "fail")


def test_bad_rules_fail_alone(spark, table):
    lists = table.withColumn("list", F.array("v"))
    rules = [between("list", 1, 2), matches("text", "("), not_null("ID"), unique("a.b"), row_count("> 0")]
    assert [r.outcome for r in evaluate(lists, rules).orderBy("position").collect()] == ["fail", "fail", "fail", "fail", "pass"]
    assert [r.unexpected_count for r in evaluate(lists, rules).orderBy("position").collect()] == [None, None, 11, 60, None]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        (found,) = evaluate(table, [not_null("ID")]).collect()
        assert (found.outcome, found.unexpected_count) == ("fail", None)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_csv_rows_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,s\n1,x\n3,z,1,EXTRA\nq,y\n4\n5,\n")
    good, bad = read_csv_checked(spark, str(tmp_path), "k int, s string")
    assert held(good) == ["Row(k=1, s='x')", "Row(k=5, s=None)"]
    assert sorted(r.line for r in bad.collect()) == ["3,z,1,EXTRA", "4", "q,y"]
    assert bad.filter(F.col("file").endswith("a.csv")).count() == 3
    (tmp_path / "b.csv").write_text("s,k\nw,9\n")
    for read in (lambda: read_csv(spark, str(tmp_path)), lambda: read_csv(spark, str(tmp_path), "k int, s string")):
        with pytest.raises(Exception, match="(?i)header"):
            read().collect()
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_checked(spark, str(tmp_path), "k int, s string")


def test_result_tables_gain_columns(spark, tmp_path):
    path, prefix = str(tmp_path), "grown_"
    spark.range(2).write.parquet(f"{path}/scan")
    register_results(spark, path, prefix)
    spark.range(3).selectExpr("id", "'x' AS owner").write.mode("append").parquet(f"{path}/scan")
    (name,) = register_results(spark, path, prefix)
    assert sorted(map(str, spark.table(name).collect())) == sorted(
        [f"Row(id={i}, owner='x')" for i in range(3)] + [f"Row(id={i}, owner=None)" for i in range(2)]
    )
    spark.range(3).selectExpr("CAST(id AS string) AS id").write.mode("append").parquet(f"{path}/scan")
    with pytest.raises(Exception):
        register_results(spark, path, prefix)
    spark.sql(f"DROP TABLE {name}")
