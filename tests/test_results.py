"""Profiles, contracts, result tables, monitoring and alerts on small tables."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from dqspark.operators import rules as r
from dqspark.operators.contract import Contract, contract_from_draft, test_contract as run_contract
from dqspark.operators.evaluate import evaluate, failing_rows
from dqspark.operators.profile import contract_from_tables, distinct_counts, profile, suite_from_profile
from dqspark.operators.results import scan_results, suite_results
from dqspark.operators.suites import load_suite, rules_from_suite, save_suite
from dqspark.plans import monitor as m
from dqspark.plans.rulesets import FULL_CONTRACT
from dqspark.streaming import alerts as a


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice([None, rng.gauss(0, 10)]), rng.choice(["x", "yy", None])) for i in range(5000)]
    return spark.createDataFrame(rows, "id int, v double, s string").repartition(4), rows


def test_profile_against_plain_python(numbers):
    df, rows = numbers
    found = {row["column"]: row for row in profile(df).collect()}
    values = sorted(v for _, v, _ in rows if v is not None)
    assert found["v"]["nulls"] == sum(v is None for _, v, _ in rows)
    assert (found["v"]["min"], found["v"]["max"]) == (values[0], values[-1])
    assert found["v"]["mean"] == pytest.approx(sum(values) / len(values))
    assert found["v"]["distinct"] == len(set(values))
    for share, quantile in zip((0.25, 0.5, 0.75), found["v"]["quantiles"]):
        rank = sum(x <= quantile for x in values) / len(values)
        assert abs(rank - share) < 0.002
    assert (found["s"]["min_length"], found["s"]["max_length"], found["s"]["distinct"]) == (1, 2, 2)
    assert found["id"]["distinct"] == 5000 and found["id"]["type"] == "int"


def test_estimated_distinct_counts_are_close(numbers):
    found = {row["column"]: row["distinct"] for row in profile(numbers[0], exact_distinct=False).collect()}
    assert found["id"] == pytest.approx(5000, rel=0.15)


def test_profile_becomes_rules_that_hold(numbers):
    df, _ = numbers
    rules = rules_from_suite(suite_from_profile(profile(df)))
    assert {(x.rule, x.column) for x in rules} >= {("unique", "id"), ("not_null", "id"), ("between", "v")}
    assert {row["outcome"] for row in evaluate(df, rules).collect()} == {"pass"}
    worse = df.withColumn("v", F.col("v") * 2)
    assert "fail" in {row["outcome"] for row in evaluate(worse, rules).collect()}


def test_profile_of_awkward_columns(spark):
    rows = [(1, 0.0, b"x", [1]), (1, -0.0, b"x", [1]), (2, float("nan"), None, [2, None]), (None, float("nan"), b"y", None)]
    df = spark.createDataFrame(rows, "`a.b` int, `c``d` double, bytes binary, list array<int>")
    found = {row["column"]: row["distinct"] for row in profile(df).collect()}
    assert found == {"a.b": 2, "c`d": 2, "bytes": 2, "list": 2}
    some = {row["column"]: row["distinct"] for row in profile(df, exact_distinct=["bytes"]).collect()}
    assert some["bytes"] == 2 and set(some) == set(found) and None not in some.values()


def test_distinct_counts_carry_one_value_a_row(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = distinct_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schemas) == len(df.columns) and not any("," in s for s in schemas)


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id int, s string")
    assert [row["count"] for row in profile(empty).collect()] == [0, 0]
    rules = rules_from_suite(suite_from_profile(profile(empty)))
    assert [x.rule for x in rules] == ["column_exists", "column_exists"]


def test_suite_kept_as_json(spark, numbers, tmp_path):
    suite = suite_from_profile(profile(numbers[0]))
    save_suite(spark, suite, str(tmp_path / "suite"))
    assert load_suite(spark, str(tmp_path / "suite")) == suite
    (tmp_path / "by_hand.json").write_text(json.dumps(suite, indent=2))
    assert load_suite(spark, str(tmp_path / "by_hand.json")) == suite


def test_contract_draft(numbers):
    found = {row["field"]: row for row in contract_from_tables({"t": numbers[0]}).collect()}
    assert (found["id"]["required"], found["id"]["unique"]) == (True, True)
    assert (found["s"]["required"], found["s"]["unique"]) == (False, False)


def test_drafted_contract_holds_until_the_table_changes(numbers):
    df, _ = numbers
    contract = contract_from_draft(contract_from_tables({"t": df}))
    assert {x["outcome"] for x in run_contract({"t": df}, contract).collect()} == {"pass"}
    worse = df.union(df.limit(1)).withColumn("v", F.col("v").cast("float"))
    broken = {(x["rule"], x["column"]) for x in run_contract({"t": worse}, contract).filter("outcome = 'fail'").collect()}
    assert broken >= {("unique", "id"), ("field_type", "v")}


def test_contract_rules(spark):
    contract = Contract.from_dict(
        {
            "models": {
                "p": {
                    "fields": {
                        "id": {"type": "string", "required": True, "unique": True, "primaryKey": True},
                        "link": {"type": "string", "format": "uri"},
                        "price": {"type": "decimal", "precision": 5, "scale": 2},
                    },
                    "quality": [
                        {"type": "sql", "query": "SELECT COUNT(*) FROM p", "mustBeEqualTo": 2},
                        {"type": "custom", "implementation": {"type": "row_count", "must_be_greater_than": 5}},
                    ],
                },
                "c": {
                    "fields": {"pid": {"type": "string", "references": "p.id"}, "n": {"type": "int"}},
                    "primaryKey": ["pid", "n"],
                },
            },
            "relationships": [
                {"from": {"model": "c", "field": "pid"}, "to": {"model": "p", "field": "id"}},
            ],
        }
    )
    assert contract.models["p"].schema()["price"].dataType.simpleString() == "decimal(5,2)"
    p = spark.sql("SELECT * FROM VALUES ('a', 'http://x/y', 1.5BD), ('a', 'no link', 2BD) AS t(id, link, price)")
    c = spark.createDataFrame([("a", 1), ("z", 1), ("a", 1)], "pid string, n int")
    found = {(x["context"], x["rule"], x["column"]): x for x in run_contract({"p": p, "c": c}, contract).collect()}
    outcome = {k: v["outcome"] for k, v in found.items()}
    assert outcome["p", "field_type", "id"] == "pass" and outcome["p", "field_type", "price"] == "fail"
    assert outcome["p", "not_null", "id"] == "pass" and outcome["p", "unique", "id"] == "fail"
    assert outcome["p", "uri_format", "link"] == "fail" and found["p", "uri_format", "link"]["unexpected_count"] == 1
    assert outcome["p", "contract_sql", None] == "pass" and outcome["p", "row_count", None] == "fail"
    assert outcome["c", "references", "pid"] == "fail" and outcome["c", "compound_unique", "pid, n"] == "fail"
    assert len(found) == 8 + 6  # the relationship only restates the field's reference


def test_full_contract_has_no_rule_twice():
    for model in FULL_CONTRACT.models:
        stated = [(x.rule, x.definition) for x in FULL_CONTRACT.rules(model)]
        assert len(stated) == len(set(stated))


def test_suite_result_rows(numbers):
    df, _ = numbers
    results = evaluate(df, [r.column_exists("id"), r.not_null("v"), r.compound_unique(["id", "s"])])
    rows = {x["expectation_type"]: x for x in suite_results(results, "run", "time", "asset").collect()}
    assert rows["expect_column_to_exist"]["element_count"] == 0
    assert rows["expect_compound_columns_to_be_unique"]["column"] == "N/A"
    assert rows["expect_column_values_to_not_be_null"]["success"] is False
    assert {x["success_percent"] for x in rows.values()} == {200 / 3}


def test_scan_result_rows(numbers):
    df, _ = numbers
    results = evaluate(df, [r.missing("v", warn="> 10%"), r.row_count(), r.duplicate_count(["id", "s"], fail="> 0")])
    rows = scan_results(results, "src", "t", "2024-01-01T00:00:00+00:00")
    assert all(f.dataType.simpleString() == "string" for f in rows.schema) and len(rows.columns) == 10
    assert sorted(x["metric"] for x in rows.collect()) == [
        "metric-src-t-id, s-duplicate_count",
        "metric-src-t-row_count",
        "metric-src-t-v-missing_count",
        "metric-src-t-v-row_count",
    ]


SCANS = [
    ("t1", "c", "m1", "fail", "2024-01-01T00:00:00+00:00"),
    ("t1", "c", "m1", "pass", "2024-01-01T00:00:00+00:00"),
    ("t2", "c", "m2", "warn", "2024-01-02T00:00:00+00:00"),
    ("t2", "c", "m2", "fail", "2024-01-03T00:00:00+00:00"),
]


@pytest.fixture(scope="module")
def scans(spark):
    return spark.createDataFrame(SCANS, "`table` string, `column` string, metric string, outcome string, datetime string")


def test_rates_of_nothing_are_null(scans):
    assert m.outcome_rate(scans, "fail", "2030-01-01", "2030-01-02").first()[0] is None
    assert m.outcome_rate(scans, "fail").first()[0] == 50.0


def test_fail_share_leaves_out_good_runs(scans):
    assert [x["fail_percentage"] for x in m.fail_pct_over_time(scans).collect()] == [50.0, 100.0]


def test_order_of_reports(spark, scans):
    more = scans.union(scans.filter("`table` = 't2' AND outcome = 'fail'"))
    assert [x["table_name"] for x in m.fails_per_table(more).collect()] == ["t2", "t1"]
    assert [x["metric"] for x in m.fails_per_metric(more).collect()] == ["m2", "m1"]


def test_alert_message(scans):
    rows = a.alerts(scans, "o", "p", F.col("metric"), F.col("datetime"))
    messages = [json.loads(x["message"]) for x in rows.collect()]
    assert sorted(x["validacao"] for x in messages) == ["m1", "m2"]
    assert set(messages[0]) == {"origem", "pipeline", "validacao", "detalhes"}


def test_alert_text_names_missing_parts(spark):
    messages = spark.createDataFrame([('{"origem":"o","pipeline":"p"}',), ("not json",)], "message string")
    texts = [x["text"] for x in a.alert_text(messages).collect()]
    assert "**Origem**: o\n" in texts[0] and texts[0].endswith("**Detalhes**: Desconhecido")
    assert texts[1].count("Desconhecido") == 4


def test_digest_counts_equal_lines(scans):
    many = scans.union(scans).filter("outcome <> 'pass'")
    found = {x["datetime"]: x for x in a.warning_digest(many, "datetime", F.col("metric"), F.col("outcome")).collect()}
    assert found["2024-01-02T00:00:00+00:00"]["digest"] == "Test: m2 | Result: warn | Count: 2"
    assert sum(x["warnings"] for x in found.values()) == 6


def test_stream_takes_each_file_once(spark, scans, tmp_path):
    results, out, checkpoint = (str(tmp_path / x) for x in ("results", "out", "checkpoint"))

    def drain():
        a.alert_stream(
            spark, results, scans.schema, out, checkpoint, "o", "p", F.col("metric"), F.col("datetime")
        ).awaitTermination()

    scans.write.mode("append").parquet(results)
    drain()
    drain()
    assert spark.read.parquet(out).count() == 2
    scans.write.mode("append").parquet(results)
    drain()
    assert spark.read.parquet(out).count() == 4


def test_failing_rows_of_a_compound_key(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), (None, None), (None, None)], "x string, y int")
    assert [x["x"] for x in failing_rows(df, r.compound_unique(["x", "y"])).collect()] == ["a", "a"]


@pytest.mark.parametrize(
    "bound, outcome",
    [
        ({"mustBe": 2}, "pass"), ({"mustNotBe": 2}, "fail"), ({"mustBeEqualTo": 3}, "fail"), ({"mustNotBeEqualTo": 3}, "pass"),
        ({"mustBeGreaterThan": 1}, "pass"), ({"mustBeGreaterThanOrEqualTo": 3}, "fail"), ({"mustBeLessThan": 0}, "fail"),
        ({"mustBeLessThanOrEqualTo": 2}, "pass"), ({"mustBeBetween": [3, 4]}, "fail"), ({"mustBeGreaterThan": 1e-05}, "pass"),
    ],
)
def test_contract_bounds(spark, bound, outcome):
    check = {"type": "sql", "query": "SELECT count(*) FROM t", **bound}
    contract = Contract.from_dict({"models": {"t": {"fields": {}, "quality": [check]}}})
    assert [row["outcome"] for row in run_contract({"t": spark.range(2)}, contract).collect()] == [outcome]


def test_unknown_contract_bound_raises():
    for check in ({"mustBeAbout": 3}, {}):
        spec = {"models": {"t": {"fields": {}, "quality": [{"type": "sql", "query": "SELECT 1", **check}]}}}
        with pytest.raises(ValueError):
            Contract.from_dict(spec)
