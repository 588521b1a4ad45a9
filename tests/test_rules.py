"""Rules on hand-made tables: holds, breaks, NULL, empty table, missing column, levels."""

import random

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from dqspark.operators import rules as r
from dqspark.operators.evaluate import (
    CheckFailed,
    evaluate,
    evaluate_all,
    failing_rows,
    passes,
    summary,
    validate,
)
from dqspark.operators.suites import rules_from_suite
from dqspark.operators.thresholds import Threshold

SCHEMA = "id string, name string, n int, price double, text string"
ROWS = [
    ("a", "Ann", 1, 10.0, "1.5"),
    ("b", "Bob", 2, -1.0, "x"),
    ("b", None, 3, None, "2"),
    (None, "  ", None, 99.0, None),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def one(df, rule, **kwargs):
    (row,) = evaluate(df, [rule], **kwargs).collect()
    return row["element_count"], row["unexpected_count"], row["observed"], row["outcome"]


CASES = [
    (r.column_exists("id"), (None, None, None, "pass"), "pass"),
    (r.column_exists("zip"), (None, None, None, "fail"), "fail"),
    (r.required_columns(["id", "zip", "city"]), (None, None, 2.0, "fail"), "fail"),
    (r.columns_ordered(["id", "name", "n", "price", "text"]), (None, None, None, "pass"), "pass"),
    (r.columns_ordered(["name", "id", "n", "price", "text"]), (None, None, None, "fail"), "fail"),
    (r.columns_set(["text", "name", "id", "n", "price"]), (None, None, None, "pass"), "pass"),
    (r.column_count(5), (None, None, 5.0, "pass"), "pass"),
    (r.of_type("n", "IntegerType"), (None, None, None, "pass"), "pass"),
    (r.of_type("n", "LongType"), (None, None, None, "fail"), "fail"),
    (r.field_type("price", "double"), (None, None, None, "pass"), "pass"),
    (r.row_count("> 3"), (4, None, 4.0, "pass"), "fail"),
    (r.row_count_between(1, 3), (4, None, 4.0, "fail"), "fail"),
    (r.not_null("id"), (4, 1, None, "fail"), "pass"),
    (r.missing("id", fail="> 1"), (4, 1, 1.0, "pass"), "pass"),
    (r.missing("id", warn="> 10%", fail="> 30%"), (4, 1, 25.0, "warn"), "pass"),
    (r.missing("id", must="< 20%"), (4, 1, 25.0, "fail"), "pass"),
    (r.unique("id"), (4, 2, None, "fail"), "pass"),
    (r.unique("n"), (4, 0, None, "pass"), "pass"),
    (r.uniqueness("id", "> 0.2"), (4, 3, 0.25, "pass"), "pass"),
    (r.uniqueness("id", "> 0.99"), (4, 3, 0.25, "fail"), "pass"),
    (r.length_between("name", 3, 3), (4, 1, None, "fail"), "pass"),
    (r.length_between("name", 2), (4, 0, None, "pass"), "pass"),
    (r.between("price", 0, 50), (4, 2, None, "fail"), "pass"),
    (r.between("price", -1, 99), (4, 0, None, "pass"), "pass"),
    (r.between("price", -1, 99, strict_min=True, strict_max=True), (4, 2, None, "fail"), "pass"),
    (r.between("price", 0, 50, mostly=1 / 3), (4, 2, None, "pass"), "pass"),
    (r.between("price", 0, 50, mostly=0.34), (4, 2, None, "fail"), "pass"),
    (r.between("text", 0, 1.7), (4, 2, None, "fail"), "pass"),
    (r.non_negative("price"), (4, 1, None, "fail"), "pass"),
    (r.matches("id", "^[ab]$"), (4, 0, None, "pass"), "pass"),
    (r.matches("name", "nn", mostly=0.3), (4, 2, None, "pass"), "pass"),
    (r.invalid("name", regex="^[A-Z]", fail="> 20%"), (4, 1, 25.0, "fail"), "pass"),
    (r.invalid("id", values=["a"], warn="> 0", fail="> 90"), (4, 2, 50.0, "warn"), "pass"),
    (r.invalid("price", min=0, max=50, fail="> 60%"), (4, 2, 50.0, "pass"), "pass"),
    (r.invalid("text", kind="decimal", fail="> 20%"), (4, 1, 25.0, "fail"), "pass"),
    (r.invalid("n", kind="decimal", fail="> 0"), (4, 0, 0.0, "pass"), "pass"),
    (r.invalid("id", fail=("< 0", "> 5")), (4, 0, 0.0, "pass"), "pass"),
    (r.data_type("text", "float"), (4, 1, None, "fail"), "pass"),
    (r.data_type("text", "string"), (4, 0, None, "pass"), "pass"),
    (r.data_type("price", "int"), (4, 3, None, "fail"), "pass"),
    (r.duplicate_count(["id"], warn="> 0"), (4, None, 1.0, "warn"), "pass"),
    (r.duplicate_count(["id", "name"], fail="> 0"), (4, None, 0.0, "pass"), "pass"),
    (r.compound_unique(["id", "name"]), (4, 0, None, "pass"), "pass"),
    (r.metric_min("price", fail="< 0", warn="< 0"), (4, None, -1.0, "fail"), "pass"),
    (r.metric_max("price", must="<= 100"), (4, None, 99.0, "pass"), "fail"),
    (r.distinct_between("id", 2, 2), (4, None, 2.0, "pass"), "fail"),
    (r.sql_metric("m", "SELECT COUNT(*) FROM t WHERE price < 0", fail="> 0"), (None, None, 1.0, "fail"), "pass"),
    (r.custom_sql("SELECT id FROM primary WHERE price > 1000"), (None, 0, None, "pass"), "pass"),
    (r.contract_sql("SELECT MAX(n) AS m FROM t", must_be_between=(0, 3)), (None, None, 3.0, "pass"), "fail"),
    (
        r.contract_sql("SELECT MIN(n) AS a, MAX(n) AS b FROM t", must_satisfy=["a >= 1", "b < 3"]),
        (None, 1, None, "fail"),
        "fail",
    ),
    (r.not_null("zip"), (None, None, None, "fail"), "fail"),
    (r.unique("zip"), (None, None, None, "fail"), "fail"),
]


@pytest.mark.parametrize("rule, wanted, on_empty", CASES, ids=lambda v: getattr(v, "definition", None))
def test_rule(rule, wanted, on_empty, table, empty):
    assert one(table, rule, name="t") == wanted
    assert one(empty, rule, name="t")[-1] == on_empty


def test_all_rules_in_one_call_agree_with_one_by_one(table):
    rules = [rule for rule, _, _ in CASES]
    together = {row["position"]: row for row in evaluate(table, rules, "t").collect()}
    assert sorted(together) == list(range(1, len(rules) + 1))
    for position, (rule, wanted, _) in enumerate(CASES, start=1):
        row = together[position]
        assert (row["element_count"], row["unexpected_count"], row["observed"], row["outcome"]) == wanted
        assert row["rule"] == rule.rule and row["column"] == rule.column


def test_two_rules_on_the_same_columns_share_their_aggregates(table):
    text = evaluate(table, [r.not_null("id"), r.missing("id", fail="> 0")])._jdf.queryExecution().optimizedPlan()
    assert text.toString().count("count_if") + text.toString().count("count(if") <= 1


def test_references(spark, table):
    parents = spark.createDataFrame([("a",), ("z",), (None,)], "key string")
    tables = {"p": parents}
    assert one(table, r.references("id", "p", "key"), tables=tables) == (4, 2, None, "fail")
    assert one(table.filter("id = 'a'"), r.references("id", "p", "key"), tables=tables) == (1, 0, None, "pass")
    assert one(table, r.references("id", "p", "no_column"), tables=tables)[-1] == "fail"
    assert one(table, r.references("id", "nowhere", "key"), tables=tables)[-1] == "fail"
    assert failing_rows(table, r.references("id", "p", "key"), tables).count() == 2


def test_references_of_one_column_share_a_pass(spark, table):
    tables = {n: spark.createDataFrame([(k,)], "key string") for n, k in (("p", "a"), ("q", "b"))}
    rules = [r.references("id", "p", "key"), r.references("id", "q", "key"), r.references("id", "none", "key")]
    results = evaluate(table, rules, tables=tables)
    found = {x["position"]: (x["element_count"], x["unexpected_count"], x["outcome"]) for x in results.collect()}
    assert found == {1: (4, 2, "fail"), 2: (4, 1, "fail"), 3: (None, None, "fail")}
    assert passes(rules) == 1


def test_references_between_text_and_numbers(spark):
    child = spark.createDataFrame([("1",), ("2",), ("x",)], "k string")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert one(child, r.references("k", "p", "k"), tables={"p": parent}) == (3, 1, None, "fail")


def test_failing_rows(table):
    assert [x["id"] for x in failing_rows(table, r.not_null("name")).collect()] == ["b"]
    broken = failing_rows(table, r.between("price", 0, 50)).collect()
    assert sorted(x["invalid_value"] for x in broken) == [-1.0, 99.0]
    assert [x["n"] for x in failing_rows(table, r.unique("id")).orderBy("n").collect()] == [2, 3]
    assert failing_rows(table, r.custom_sql("SELECT * FROM primary WHERE n > 1")).count() == 2
    with pytest.raises(TypeError):
        failing_rows(table, r.row_count())


def test_fail_beats_warn(table):
    assert one(table, r.missing("id", warn="> 0", fail="> 0"))[-1] == "fail"


def test_suite_success(table):
    rules = [r.not_null("id"), r.not_null("price"), r.row_count("> 0"), r.missing("id", warn="> 0")]
    rows = validate(table, rules).collect()
    assert {row["success_percent"] for row in rows} == {50.0}
    assert sorted(row["success"] for row in rows) == [False, False, True, True]
    total = summary(evaluate(table, rules)).first()
    assert (total["evaluated"], total["successful"], total["success"]) == (4, 2, False)


def test_raise_on_fail(table):
    with pytest.raises(CheckFailed, match=r"not_null\(id\)"):
        validate(table, [r.not_null("id")], raise_on_fail=True)
    assert validate(table, [r.row_count()], raise_on_fail=True).count() == 1


def test_several_tables(table, empty):
    rows = evaluate_all({"a": table, "b": empty}, {"a": [r.row_count()], "b": [r.row_count()]}, "dq_").collect()
    assert {row["context"]: row["outcome"] for row in rows} == {"dq_a": "pass", "dq_b": "fail"}


def test_no_rules(table):
    assert evaluate(table, []).count() == 0


def test_sql_leaves_the_session_as_it_was(spark, table):
    spark.range(7).createOrReplaceTempView("mine")
    results = evaluate(table, [r.sql_metric("n", "SELECT COUNT(*) FROM mine", must="= 4")], "mine")
    assert spark.table("mine").count() == 7
    assert not spark.catalog.tableExists("primary")
    assert results.first()["outcome"] == "pass"


def test_sql_on_missing_columns_fails_and_stops_nothing(table):
    rules = [r.sql_metric("m", "SELECT MAX(zip) FROM primary", must="> 0"), r.row_count()]
    assert [x["outcome"] for x in evaluate(table, rules).orderBy("position").collect()] == ["fail", "pass"]
    with pytest.raises(ParseException):
        evaluate(table, [r.custom_sql("SELEC 1")])


def test_passes():
    assert passes([r.column_exists("a")]) == 0
    assert passes([r.not_null("a"), r.row_count(), r.unique("a"), r.unique("b")]) == 2
    assert passes([r.not_null("a"), r.custom_sql("x"), r.references("a", "p", "k")]) == 3


def test_more_key_columns_than_one_grouping_takes(spark):
    names = [f"c{i}" for i in range(70)]
    df = spark.range(10).select(*[(F.col("id") % (i + 1)).alias(n) for i, n in enumerate(names)])
    found = evaluate(df, [r.distinct_between(n, 1, 10) for n in names]).collect()
    assert sorted(row["observed"] for row in found) == sorted(float(min(i + 1, 10)) for i in range(70))


def test_threshold_text():
    assert Threshold.of(" >= 2.5 % ") == Threshold(">=", 2.5, True)
    with pytest.raises(ValueError):
        Threshold.of("about 3")


def test_suite_from_dictionary(table):
    suite = {
        "expectations": [
            {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "id"}},
            {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1, "max_value": 9}},
            {"expectation_type": "expect_table_column_count_to_equal", "kwargs": {"value": 5}},
            {"expectation_type": "expect_compound_columns_to_be_unique", "kwargs": {"column_list": ["id", "name"]}},
            {
                "expectation_type": "expect_column_values_to_be_of_type",
                "kwargs": {"column": "n", "type_": "IntegerType"},
            },
            {
                "expectation_type": "expect_column_distinct_count_to_be_between",
                "kwargs": {"column": "id", "min_value": 1, "max_value": 2},
            },
            {
                "expectation_type": "expect_table_columns_to_match_ordered_list",
                "kwargs": {"column_list": ["id", "name", "n", "price", "text"]},
            },
        ]
    }
    assert {row["outcome"] for row in evaluate(table, rules_from_suite(suite)).collect()} == {"pass"}


def test_against_plain_python_on_random_tables(spark):
    """A hot key, NULLs and repeats: counts per key against a dictionary."""
    rng = random.Random(7)
    rows = [
        (rng.choice(["hot", "hot", None, f"k{rng.randrange(40)}"]), rng.choice([None, 1, 2, 3])) for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "k string, v int").repartition(6)
    singles = {}
    pairs = {}
    for k, v in rows:
        singles[k] = singles.get(k, 0) + 1
        pairs[(k, v)] = pairs.get((k, v), 0) + 1
    rules = [
        r.unique("k"),
        r.uniqueness("k", "> 0"),
        r.duplicate_count(["k", "v"], fail="> 0"),
        r.compound_unique(["k", "v"]),
        r.distinct_between("k", 1, 41),
    ]
    found = {row["position"]: row for row in evaluate(df, rules).collect()}
    assert found[1]["unexpected_count"] == sum(n for k, n in singles.items() if k is not None and n > 1)
    assert found[2]["observed"] == sum(n == 1 and k is not None for k, n in singles.items()) / len(rows)
    assert found[3]["observed"] == sum(n > 1 and None not in key for key, n in pairs.items())
    assert found[4]["unexpected_count"] == sum(n for key, n in pairs.items() if key != (None, None) and n > 1)
    assert found[5]["observed"] == len([k for k in singles if k is not None])


def test_a_bad_query_fails_alone(spark):
    df = spark.range(4)
    rules = [
        r.sql_metric("dotted", "SELECT 100.0 * count(*) FROM primary", must="= 400"),
        r.sql_metric("average", "SELECT avg(id) * 1.5 FROM primary", must="> 0"),
        r.sql_metric("several", "SELECT id FROM primary", must=">= 0"),
        r.contract_sql("SELECT count(*) AS n FROM primary", must_satisfy=["n = 4"]),
        r.contract_sql("SELECT count(*) AS n FROM primary", must_satisfy=["missing = 4"]),
        r.row_count_between(1, None),
        r.distinct_between("id", None, 3),
        r.row_count("< 1e+20"),
    ]
    found = {row["position"]: row["outcome"] for row in evaluate(df, rules).collect()}
    assert list(dict(sorted(found.items())).values()) == ["pass", "pass", "fail", "pass", "fail", "pass", "fail", "pass"]
    for bad in (lambda: r.contract_sql("SELECT 1"), lambda: r.row_count_between(None, None)):
        with pytest.raises(ValueError):
            bad()


def test_mostly_of_suites(spark):
    df = spark.createDataFrame([(1, 1), (2, None), (3, 3), (3, 4)], "a int, b int")
    kinds = ["expect_column_values_to_not_be_null", "expect_column_values_to_be_unique"]
    suite = [(kinds[0], "b", 0.75), (kinds[0], "b", 0.8), (kinds[1], "a", 0.5), (kinds[1], "a", 0.6)]
    made = {"expectations": [{"expectation_type": k, "kwargs": {"column": c, "mostly": m}} for k, c, m in suite]}
    found = evaluate(df, rules_from_suite(made)).orderBy("position").collect()
    assert [row["outcome"] for row in found] == ["pass", "fail", "pass", "fail"]


def test_reference_keys_agree(spark):
    child = spark.createDataFrame([("1",), ("x",), (None,), ("9",)], "k string")
    parent = spark.createDataFrame([(1.0,), (2.0,)], "p double")
    rule, tables = r.references("k", "t", "p"), {"t": parent}
    assert evaluate(child, [rule], "c", tables).first()["unexpected_count"] == 2 == failing_rows(child, rule, tables).count()
