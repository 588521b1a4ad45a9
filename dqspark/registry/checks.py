"""Each kind of rule by itself, on the raw sales or on a given table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dqspark.operators import rules as r
from dqspark.operators.evaluate import evaluate
from dqspark.plans.columns import SALES_TYPES
from dqspark.plans.warehouse import cast_columns
from dqspark.registry import sql
from dqspark.registry.results import OUTCOME_COLUMNS
from dqspark.registry.suites import NOT_WHOLE
from dqspark.registry.inputs import given, raw_sales

_NOT_NUMBER = r"NOT regexp_matches({c}, '^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$')"

# Name -> (table, rules, the same as SQL).
CASES: dict[str, tuple[str, list[r.Rule], list[sql.Check]]] = {
    "rule_schema": (
        "stg_sales",
        [
            r.column_exists("product_id"),
            r.column_exists("no_such_column"),
            r.required_columns(["product_id", "user_id", "no_such_column"]),
            r.columns_ordered(list(SALES_TYPES)),
            r.columns_ordered(list(reversed(SALES_TYPES))),
            r.columns_set(list(reversed(SALES_TYPES))),
            r.column_count(16),
            r.column_count(15),
            r.of_type("rating_count", "IntegerType"),
            r.of_type("rating", "IntegerType"),
            r.field_type("rating", "double"),
            r.field_type("actual_price", "decimal(10,2)"),
            r.not_null("no_such_column"),
            r.row_count("> 0"),
        ],
        [
            sql.schema("column_exists", "product_id"),
            sql.lacking("column_exists", "no_such_column"),
            sql.schema("required_columns", holds=False, observed="1"),
            sql.schema("columns_ordered"),
            sql.schema("columns_ordered", holds=False),
            sql.schema("columns_set"),
            sql.schema("column_count", observed="16"),
            sql.schema("column_count", holds=False, observed="16"),
            sql.schema("of_type", "rating_count"),
            sql.schema("of_type", "rating", holds=False),
            sql.schema("field_type", "rating"),
            sql.schema("field_type", "actual_price", holds=False),
            sql.lacking("not_null", "no_such_column"),
            sql.rows("{v} > 0"),
        ],
    ),
    "rule_row_count": (
        "lineitem",
        [r.row_count("> 0"), r.row_count_between(10, 1000), r.row_count("> 0", warn="> 1000", fail="> 1000000000")],
        [
            sql.rows("{v} > 0"),
            sql.rows("{v} BETWEEN 10 AND 1000"),
            sql.rule(
                "row_count",
                None,
                "count(*)",
                observed="count(*)",
                outcome=sql.levels("count(*)", "{v} > 1000000000 OR NOT {v} > 0", "{v} > 1000"),
            ),
        ],
    ),
    "rule_not_null": (
        "raw_sales",
        [r.not_null("category"), r.not_null("product_id")],
        [sql.not_null("category"), sql.not_null("product_id")],
    ),
    "rule_missing_pct": (
        "raw_sales",
        [
            r.missing("user_name", warn="> 1%", fail="> 10%"),
            r.missing("review_content", warn="> 5%", fail="> 10%"),
            r.missing("rating_count", must="< 5%"),
            r.missing("category", fail="> 0"),
        ],
        [
            sql.missing("user_name", "{v} > 10", "{v} > 1", percent=True),
            sql.missing("review_content", "{v} > 10", "{v} > 5", percent=True),
            sql.missing("rating_count", "NOT {v} < 5", percent=True),
            sql.missing("category", "{v} > 0"),
        ],
    ),
    "rule_unique": (
        "raw_sales",
        [r.unique("review_id"), r.unique("category")],
        [sql.unique("review_id"), sql.unique("category")],
    ),
    "rule_unique_key": ("orders", [r.unique("o_orderkey")], [sql.unique("o_orderkey")]),
    "rule_uniqueness": (
        "raw_sales",
        [r.uniqueness("review_id", "> 0.99"), r.uniqueness("review_id", "> 0.5")],
        [sql.uniqueness("review_id", "{v} > 0.99"), sql.uniqueness("review_id", "{v} > 0.5")],
    ),
    "rule_compound_unique": (
        "lineitem",
        [r.compound_unique(["l_orderkey", "l_linenumber"])],
        [sql.unique("l_orderkey, l_linenumber", "compound_unique")],
    ),
    "rule_duplicate_count": (
        "raw_sales",
        [
            r.duplicate_count(["review_id"], fail="> 0"),
            r.duplicate_count(["user_id", "product_id"], warn="> 0"),
            r.duplicate_count(["category", "user_name"], must="= 0"),
        ],
        [
            sql.duplicate_count("review_id", "{v} > 0"),
            sql.duplicate_count("user_id, product_id", warn="{v} > 0"),
            sql.duplicate_count("category, user_name", "NOT {v} = 0"),
        ],
    ),
    "rule_length": (
        "raw_sales",
        [
            r.length_between("about_product", 20, 29),
            r.length_between("review_title", 3),
            r.length_between("category", None, 7, mostly=0.5),
        ],
        [
            sql.broken("length_between", "about_product", "length(about_product) NOT BETWEEN 20 AND 29"),
            sql.broken("length_between", "review_title", "length(review_title) < 3"),
            sql.broken("length_between", "category", "length(category) > 7", 0.5),
        ],
    ),
    "rule_between_mostly": (
        "stg_sales",
        [
            r.between("actual_price", 1000, 100000, mostly=0.95),
            r.between("actual_price", 1000, 100000, mostly=0.999999),
            r.between("rating", 0, 5, strict_min=True, strict_max=True),
            r.between("discount_percentage", None, 5, mostly=0.5),
            r.non_negative("rating_count"),
        ],
        [
            sql.broken("between", "actual_price", "actual_price < 1000 OR actual_price > 100000", 0.95),
            sql.broken("between", "actual_price", "actual_price < 1000 OR actual_price > 100000", 0.999999),
            sql.broken("between", "rating", "rating <= 0 OR rating >= 5"),
            sql.broken("between", "discount_percentage", "discount_percentage > 5", 0.5),
            sql.broken("non_negative", "rating_count", "rating_count < 0"),
        ],
    ),
    "rule_between_text": (
        "raw_sales",
        [r.between("rating", 0, 5)],
        [
            sql.broken(
                "between",
                "rating",
                "rating IS NOT NULL AND (TRY_CAST(rating AS DOUBLE) IS NULL OR TRY_CAST(rating AS DOUBLE) < 0 "
                "OR TRY_CAST(rating AS DOUBLE) > 5)",
            )
        ],
    ),
    "rule_regex_mostly": (
        "raw_sales",
        [
            r.matches("product_link", "http[s]?://.*", mostly=0.9),
            r.matches("img_link", r"\.jpg$", mostly=0.95),
            r.matches("review_id", "^[a-zA-Z0-9_-]+$"),
            r.uri_format("product_link"),
        ],
        [
            sql.broken("matches", "product_link", "NOT regexp_matches(product_link, 'http[s]?://.*')", 0.9),
            sql.broken("matches", "img_link", r"NOT regexp_matches(img_link, '\.jpg$')", 0.95),
            sql.broken("matches", "review_id", "NOT regexp_matches(review_id, '^[a-zA-Z0-9_-]+$')"),
            sql.broken(
                "uri_format",
                "product_link",
                r"NOT regexp_matches(product_link, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^\s]+$')",
            ),
        ],
    ),
    "rule_invalid_regex": (
        "raw_sales",
        [r.invalid("img_link", regex=r"^https?://.*\.(jpg|jpeg|png|gif)$", warn="> 5%", fail="> 50%")],
        [
            sql.invalid(
                "img_link",
                r"NOT regexp_matches(img_link, '^https?://.*\.(jpg|jpeg|png|gif)$')",
                "{v} > 50",
                "{v} > 5",
            )
        ],
    ),
    "rule_invalid_values": (
        "raw_sales",
        [r.invalid("category", values=["STANDARD", "SMALL", "MEDIUM"], warn="> 5%", fail="> 90%")],
        [sql.invalid("category", "category NOT IN ('STANDARD', 'SMALL', 'MEDIUM')", "{v} > 90", "{v} > 5")],
    ),
    "rule_invalid_range": (
        "stg_sales",
        [r.invalid("rating", min=1, max=4, warn="> 5%", fail="> 60%"), r.invalid("rating_count", min=0, fail="> 0")],
        [
            sql.invalid("rating", "rating < 1 OR rating > 4", "{v} > 60", "{v} > 5"),
            sql.invalid("rating_count", "rating_count < 0", "{v} > 0"),
        ],
    ),
    "rule_invalid_type": (
        "raw_sales",
        [
            r.invalid("rating", kind="decimal", fail="> 5%"),
            r.invalid("user_id", kind="integer", fail="> 5%"),
            r.invalid("category", fail="> 0"),
            r.data_type("rating", "float"),
            r.data_type("rating_count", "int"),
            r.data_type("user_name", "string"),
        ],
        [
            sql.invalid("rating", _NOT_NUMBER.format(c="rating"), "{v} > 5"),
            sql.invalid("user_id", NOT_WHOLE.format(c="user_id"), "{v} > 5"),
            sql.invalid("category", "false", "{v} > 0"),
            sql.broken("data_type", "rating", _NOT_NUMBER.format(c="rating")),
            sql.broken("data_type", "rating_count", NOT_WHOLE.format(c="rating_count")),
            sql.broken("data_type", "user_name", "false"),
        ],
    ),
    "rule_min_max": (
        "stg_sales",
        [
            r.metric_min("actual_price", must="> 0"),
            r.metric_min("actual_price", warn="< 1000", fail="< 0"),
            r.metric_max("rating", fail="> 5", warn=">= 5"),
        ],
        [
            sql.extreme("min", "actual_price", "NOT {v} > 0"),
            sql.extreme("min", "actual_price", "{v} < 0", "{v} < 1000"),
            sql.extreme("max", "rating", "{v} > 5", "{v} >= 5"),
        ],
    ),
    "rule_distinct_between": (
        "raw_sales",
        [r.distinct_between("category", 1, 100), r.distinct_between("product_id", 1, 10)],
        [sql.distinct_between("category", 1, 100), sql.distinct_between("product_id", 1, 10)],
    ),
    "rule_sql_metric": (
        "lineitem",
        [
            r.sql_metric("returns", "SELECT COUNT(*) FROM lineitem WHERE l_returnflag = 'R'", warn="> 0"),
            r.sql_metric("high_tax", "SELECT COUNT(*) FROM primary WHERE l_tax > 0.07", fail="> 0"),
            r.sql_metric("top_tax", "SELECT MAX(l_tax) FROM primary", must="<= 1"),
        ],
        [
            sql.one_number("returns", "SELECT COUNT(*) FROM lineitem WHERE l_returnflag = 'R'", warn="{v} > 0"),
            sql.one_number(
                "high_tax", "SELECT COUNT(*) FROM lineitem WHERE l_tax > CAST(0.07 AS DOUBLE)", "{v} > 0"
            ),
            sql.one_number("top_tax", "SELECT MAX(l_tax) FROM lineitem", "NOT {v} <= 1"),
        ],
    ),
    "rule_custom_sql": (
        "orders",
        [
            r.custom_sql("SELECT o_totalprice FROM primary WHERE o_totalprice < 0"),
            r.custom_sql("SELECT o_orderkey FROM primary WHERE o_orderstatus = 'P'"),
        ],
        [
            sql.bad_rows("SELECT o_totalprice FROM orders WHERE o_totalprice < 0"),
            sql.bad_rows("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'"),
        ],
    ),
    "rule_contract_sql": (
        "lineitem",
        [
            r.contract_sql("SELECT COUNT(*) AS n FROM lineitem", must_be_greater_than=1000),
            r.contract_sql("SELECT MAX(l_quantity) AS top FROM lineitem", must_be_between=(0, 50)),
            r.contract_sql("SELECT COUNT(*) AS n FROM lineitem WHERE l_returnflag = 'R'", must_be_equal_to=0),
            r.contract_sql("SELECT MAX(l_tax) AS top FROM lineitem WHERE l_tax > 9", must_be_between=(0, 5)),
        ],
        [
            sql.number_within("SELECT COUNT(*) FROM lineitem", "{v} > 1000"),
            sql.number_within("SELECT MAX(l_quantity) FROM lineitem", "{v} BETWEEN 0 AND 50"),
            sql.number_within("SELECT COUNT(*) FROM lineitem WHERE l_returnflag = 'R'", "{v} = 0"),
            sql.number_within("SELECT MAX(l_tax) FROM lineitem WHERE l_tax > 9", "{v} BETWEEN 0 AND 5"),
        ],
    ),
    "rule_contract_satisfy": (
        "stg_sales",
        [
            r.contract_sql(
                "SELECT MIN(rating) AS lowest, MAX(rating) AS highest FROM stg_sales",
                must_satisfy=["lowest >= 1.0", "highest <= 5.0"],
            )
        ],
        [
            sql.rule(
                "contract_sql",
                None,
                unexpected="CASE WHEN lowest >= 1 THEN 0 ELSE 1 END + CASE WHEN highest <= 5 THEN 0 ELSE 1 END",
                outcome=sql.either("lowest >= 1 AND highest <= 5"),
                source="(SELECT MIN(rating) AS lowest, MAX(rating) AS highest FROM {table}) AS q",
            )
        ],
    ),
    "rule_references": (
        "orders",
        [
            r.references("o_custkey", "customer", "c_custkey"),
            r.references("o_custkey", "events", "user_id"),
            r.references("o_custkey", "supplier", "s_suppkey"),
        ],
        [
            sql.references("o_custkey", "customer", "c_custkey"),
            sql.references("o_custkey", "events", "user_id"),
            sql.references("o_custkey", "supplier", "s_suppkey"),
        ],
    ),
}

_PARENTS = ("customer", "events", "supplier")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "raw_sales":
        return raw_sales(spark, sf_dir)
    if name == "stg_sales":
        return cast_columns(raw_sales(spark, sf_dir))
    return given(spark, sf_dir, name)


def _query(table: str, rules: list[r.Rule], parents: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        others = {name: given(spark, sf_dir, name) for name in parents}
        return evaluate(_table(spark, sf_dir, table), rules, table, others).select(*OUTCOME_COLUMNS)

    return query


QUERIES = {
    name: _query(table, rules, _PARENTS if name == "rule_references" else ())
    for name, (table, rules, _) in CASES.items()
}
ORACLES = {name: sql.with_tables(table, sql.all_of(table, checks)) for name, (table, _, checks) in CASES.items()}
