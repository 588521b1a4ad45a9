"""The rule lists of the warehouse, run on each table; results in the result-table shapes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqspark.operators.contract import test_contract
from dqspark.operators.evaluate import evaluate, evaluate_all, passes, summary, union_results, validate
from dqspark.operators.results import scan_results, suite_results
from dqspark.operators.suites import rules_from_suite
from dqspark.plans import rulesets as rs
from dqspark.plans import warehouse as w
from dqspark.plans.columns import DIM_PRODUCT
from dqspark.registry import sql
from dqspark.registry.results import OUTCOME_COLUMNS
from dqspark.registry.sql import (
    broken,
    distinct_between,
    duplicate_count,
    extreme,
    invalid,
    lacking,
    missing,
    not_null,
    number_within,
    one_number,
    references,
    rows,
    schema,
    unique,
    uniqueness,
)
from dqspark.session import stored, together
from dqspark.registry.inputs import raw_sales

RUN_NAME, RUN_TIME, SCAN_TIME = "nightly", "20240130T010000.000000Z", "2024-01-30T01:00:00+00:00"


def _kept_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales, written down for tables that would join them several times: the columns that the five tables read."""
    columns = dict.fromkeys([*DIM_PRODUCT, "user_id", "user_name", "rating", "rating_count", "actual_price"])
    return stored(raw_sales(spark, sf_dir).select(*columns), "raw-sales")


def warehouse_tables(spark: SparkSession, sf_dir: str, facts: bool = True) -> dict[str, DataFrame]:
    """All five tables, lazily; for ``facts``, which read the sales three times each, from sales written down once."""
    raw = _kept_sales(spark, sf_dir) if facts else raw_sales(spark, sf_dir)
    products, users, ratings = w.dim_product(raw), w.dim_user(raw), w.dim_rating(raw)
    return {
        "dim_product": products,
        "dim_user": users,
        "dim_rating": ratings,
        "fact_product_rating": w.fact_product_rating(raw, products, ratings),
        "fact_sales_category": w.fact_sales_category(raw, products, users),
    }


def _ready(table: DataFrame, rules: list) -> DataFrame:
    """The table, written down first when its rules read it more than once."""
    return stored(table, "checked") if passes(rules) > 1 else table


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five tables written down, the facts built from the stored dimensions."""
    raw = _kept_sales(spark, sf_dir)
    dims = together(
        {
            "dim_product": lambda: stored(w.dim_product(raw), "dim_product"),
            "dim_user": lambda: stored(w.dim_user(raw), "dim_user"),
            "dim_rating": lambda: stored(w.dim_rating(raw), "dim_rating"),
        }
    )
    products, users, ratings = dims["dim_product"], dims["dim_user"], dims["dim_rating"]
    return dims | together(
        {
            "fact_product_rating": lambda: stored(w.fact_product_rating(raw, products, ratings), "fact"),
            "fact_sales_category": lambda: stored(w.fact_sales_category(raw, products, users), "fact"),
        }
    )


def obt_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.build_obt(raw_sales(spark, sf_dir), [F.col("review_id").desc_nulls_last()])


FACTS = ("fact_product_rating", "fact_sales_category")
TABLES = ("dim_product", "dim_user", "dim_rating", "fact_product_rating", "fact_sales_category")


def _on_table(name: str, rules: list) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = warehouse_tables(spark, sf_dir, name in FACTS)
        return evaluate(_ready(tables[name], rules), rules, name, tables).select(*OUTCOME_COLUMNS)

    return query


def suite_obt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(_ready(obt_sales(spark, sf_dir), rs.OBT_SUITE), rs.OBT_SUITE).select(*OUTCOME_COLUMNS)


def scan_obt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(_ready(obt_sales(spark, sf_dir), rs.OBT_SCAN), rs.OBT_SCAN).select(*OUTCOME_COLUMNS)


def _scan_folder(folder: dict[str, list]) -> Callable[[SparkSession, str], DataFrame]:
    """All checks of a folder in one frame."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = warehouse_tables(spark, sf_dir, any(name in FACTS for name in folder))
        ready = {name: _ready(tables[name], rules) for name, rules in folder.items()}
        return evaluate_all(ready, folder, "scan_").select("context", *OUTCOME_COLUMNS)

    return query


def _suite(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rules = rs.SUITES[name]
    return evaluate(_ready(warehouse_tables(spark, sf_dir, name in FACTS)[name], rules), rules, name)


def suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(_suite(spark, sf_dir, "dim_product"))


def suite_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suite in its dictionary form, with the success of each rule and of the whole."""
    rules = rules_from_suite(rs.SUITE_DICTS["dim_user"])
    return validate(_ready(warehouse_tables(spark, sf_dir, False)["dim_user"], rules), rules).select(
        "position", "rule", "success", "success_percent"
    )


def results_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite_results(_suite(spark, sf_dir, "dim_product"), RUN_NAME, RUN_TIME, "dim_product")


def results_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suites of all five tables as rows of one result table."""
    tables = stored_tables(spark, sf_dir)
    return union_results(
        [suite_results(evaluate(tables[t], rs.SUITES[t], t), RUN_NAME, RUN_TIME, t) for t in TABLES]
    )


def results_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rs.DIM_SCANS["dim_rating"]
    ratings = _ready(warehouse_tables(spark, sf_dir, False)["dim_rating"], rules)
    return scan_results(evaluate(ratings, rules), "sales", "dim_rating", SCAN_TIME)


def contract_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return test_contract(stored_tables(spark, sf_dir), rs.QUALITY_CONTRACT).select("context", *OUTCOME_COLUMNS)


def contract_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types, required and unique fields, keys, formats, embedded checks and relationships."""
    return test_contract(stored_tables(spark, sf_dir), rs.FULL_CONTRACT).select("context", *OUTCOME_COLUMNS)


# --------------------------------------------------------------------------- the same as SQL

NOT_WHOLE = r"NOT regexp_matches({c}, '^\s*[-+]?[0-9]+\s*$')"


def _not_whole(column: str) -> str:
    return NOT_WHOLE.format(c=column)


def _exist(*columns: str) -> list:
    return [schema("column_exists", c) for c in columns]


def _of_kind(*columns: str) -> list:
    """Columns whose every value fits, whether by type or because text always does."""
    return [broken("data_type", c, "false") for c in columns]


RULESET_CHECKS = {
    "dim_user": [
        *_exist("user_id", "user_name"),
        not_null("user_id"),
        not_null("user_name"),
        uniqueness("user_id", "{v} > 0.99"),
        rows("{v} > 0"),
        broken("data_type", "user_id", _not_whole("user_id")),
        *_of_kind("user_name"),
    ],
    "dim_product": [
        *_exist("product_id", "product_name", "category", "about_product", "img_link", "product_link"),
        *[not_null(c) for c in ("product_id", "product_name", "category", "img_link", "product_link")],
        uniqueness("product_id", "{v} > 0.99"),
        *_of_kind("product_id", "product_name", "category", "about_product", "img_link", "product_link"),
    ],
    "dim_rating": [
        *_exist("user_id", "product_id", "rating", "rating_count"),
        *[not_null(c) for c in ("user_id", "product_id", "rating", "rating_count")],
        *_of_kind("user_id", "product_id", "rating", "rating_count"),
        rows("{v} > 0"),
    ],
    "fact_product_rating": [
        *_exist("product_id", "product_name", "avg_rating"),
        *[not_null(c) for c in ("product_id", "product_name", "avg_rating")],
        *_of_kind("product_id", "product_name", "avg_rating"),
        rows("{v} > 0"),
        sql.bad_rows("SELECT avg_rating FROM fact_product_rating WHERE avg_rating > 5"),
    ],
    "fact_sales_category": [
        *_exist("user_id", "category", "sales_amount"),
        *[not_null(c) for c in ("user_id", "category", "sales_amount")],
        *_of_kind("user_id", "category", "sales_amount"),
        rows("{v} > 0"),
    ],
}

SUITE_CHECKS = {
    "dim_product": [
        *_exist("product_id"),
        not_null("product_id"),
        unique("product_id"),
        not_null("product_name"),
        not_null("category"),
        broken("length_between", "about_product", "length(about_product) < 10"),
        broken("matches", "img_link", "NOT regexp_matches(img_link, 'http[s]?://.*')", 0.9),
        broken("matches", "product_link", "NOT regexp_matches(product_link, 'http[s]?://.*')", 0.9),
    ],
    "dim_rating": [
        *_exist("user_id"),
        not_null("user_id"),
        *_exist("product_id"),
        not_null("product_id"),
        *_exist("rating"),
        broken("between", "rating", "rating < 0 OR rating > 5"),
        *_exist("rating_count"),
        broken("between", "rating_count", "rating_count < 0"),
    ],
    "dim_user": [
        *_exist("user_id"),
        not_null("user_id"),
        unique("user_id"),
        *_exist("user_name"),
        not_null("user_name"),
        broken("length_between", "user_name", "length(user_name) < 3"),
    ],
    "fact_product_rating": [
        *_exist("product_id"),
        not_null("product_id"),
        *_exist("product_name"),
        not_null("product_name"),
        broken("length_between", "product_name", "length(product_name) < 3"),
        *_exist("avg_rating"),
        broken("between", "avg_rating", "avg_rating < 0 OR avg_rating > 5"),
    ],
    # The table has none of these columns.
    "fact_sales_category": [
        lacking("column_exists", "product_id"),
        lacking("not_null", "product_id"),
        lacking("column_exists", "product_name"),
        lacking("not_null", "product_name"),
        lacking("length_between", "product_name"),
        lacking("column_exists", "avg_rating"),
        lacking("between", "avg_rating"),
    ],
}

_WORD = "^[a-zA-Z0-9_-]+$"

OBT_SUITE_CHECKS = [
    schema("columns_ordered"),
    unique("product_id"),
    not_null("product_id"),
    broken("between", "discount_percentage", "discount_percentage < 0 OR discount_percentage > 100"),
    broken("between", "rating", "rating < 0 OR rating > 5"),
    broken("between", "actual_price", "actual_price < CAST(0.01 AS DOUBLE)"),
    broken("between", "discounted_price", "discounted_price < CAST(0.01 AS DOUBLE)"),
    broken("between", "rating_count", "rating_count < 0"),
    schema("of_type", "rating_count"),
    broken(
        "matches",
        "product_link",
        r"NOT regexp_matches(product_link, '^https:\/\/www\.[a-zA-Z0-9\-\.]+\.[a-zA-Z]{2,}$')",
        0.9,
    ),
    broken("matches", "img_link", r"NOT regexp_matches(img_link, '^https:\/\/.*\.(jpg|jpeg|png|webp)$')"),
    *[broken("matches", c, f"NOT regexp_matches({c}, '{_WORD}')") for c in ("review_id", "user_id", "product_id")],
    broken("length_between", "review_title", "length(review_title) NOT BETWEEN 3 AND 100"),
    unique("product_id, product_name", "compound_unique"),
]

DIM_SCAN_CHECKS = {
    "dim_product": [
        schema("required_columns", observed="0"),
        missing("product_id", "{v} > 0"),
        missing("product_name", "{v} > 0"),
        duplicate_count("product_id", warn="{v} > 0"),
        invalid(
            "category",
            "category NOT IN ('Electronics', 'Books', 'Clothing', 'Toys', 'Home', 'Beauty')",
            "{v} > 10",
            "{v} > 5",
        ),
        invalid("img_link", r"NOT regexp_matches(img_link, '^https?://.*\.(jpg|jpeg|png|gif)$')", "{v} > 0"),
        invalid("product_link", "NOT regexp_matches(product_link, '^https?://.*$')", "{v} > 0"),
        missing("about_product", warn="{v} > 10", percent=True),
    ],
    "dim_rating": [
        schema("required_columns", observed="0"),
        missing("user_id", "{v} > 0"),
        missing("product_id", "{v} > 0"),
        duplicate_count("user_id, product_id", warn="{v} > 0"),
        invalid("rating", "rating < 0 OR rating > 5", "{v} > 10", "{v} > 5"),
        missing("rating", warn="{v} > 10", percent=True),
        invalid("rating_count", "rating_count < 0", "{v} > 10", "{v} > 5"),
        missing("rating_count", warn="{v} > 10", percent=True),
    ],
    "dim_user": [
        schema("required_columns", observed="0"),
        missing("user_id", "{v} > 0"),
        duplicate_count("user_id", warn="{v} > 0"),
        missing("user_name", "{v} > 10", "{v} > 5", percent=True),
        invalid(
            "user_name",
            r"NOT regexp_matches(user_name, '^[A-Za-zÀ-ÖØ-öø-ÿ\s''''-]+$')",
            "{v} > 10",
            "{v} > 5",
        ),
    ],
}

FACT_SCAN_CHECKS = {
    "fact_product_rating": [
        schema("required_columns", observed="0"),
        missing("product_id", "{v} > 0"),
        missing("product_name", "{v} > 0"),
        extreme("min", "avg_rating", "{v} < 0", "{v} < 0"),
        extreme("max", "avg_rating", "{v} > 5", "{v} > 5"),
        one_number("rating_negativo", "SELECT COUNT(*) FROM fact_product_rating WHERE avg_rating < 0", "{v} > 0"),
        one_number(
            "nome_em_branco",
            "SELECT COUNT(*) FROM fact_product_rating WHERE TRIM(product_name) = ''",
            warn="{v} > 0",
        ),
    ],
    "fact_sales_category": [
        schema("required_columns", observed="0"),
        missing("user_id", "{v} > 0"),
        missing("category", "{v} > 0"),
        missing("sales_amount", warn="{v} > 5", percent=True),
        extreme("min", "sales_amount", "{v} < 0"),
        one_number(
            "sales_amount_outlier",
            "SELECT COUNT(*) FROM fact_sales_category WHERE sales_amount > 100000",
            warn="{v} > 0",
        ),
        one_number(
            "venda_sem_categoria",
            "SELECT COUNT(*) FROM fact_sales_category WHERE category IS NULL AND sales_amount IS NOT NULL",
            "{v} > 0",
        ),
    ],
}

OBT_SCAN_CHECKS = [
    schema("required_columns", observed="0"),
    missing("product_id", "{v} > 0"),
    missing("product_name", "{v} > 0"),
    duplicate_count("product_id", warn="{v} > 0"),
    *[missing(c, warn="{v} > 10", percent=True) for c in ("discounted_price", "actual_price", "discount_percentage")],
    *[missing(c, warn="{v} > 20", percent=True) for c in ("rating", "rating_count")],
    invalid("discount_percentage", "false", "{v} >= 100"),
    extreme("min", "discounted_price", "{v} <= 0"),
    extreme("min", "actual_price", "{v} <= 0"),
    invalid("rating", "false", "{v} < 0 OR {v} > 5"),
    duplicate_count("review_id", "{v} > 0"),
    *[
        invalid(c, "false", "{v} > 5")
        for c in ("discounted_price", "actual_price", "discount_percentage", "rating", "rating_count")
    ],
    *[invalid(c, _not_whole(c), "{v} > 5") for c in ("product_id", "user_id", "review_id")],
]

TEST_CHECKS = {
    "dim_product": [not_null("product_id"), not_null("product_name"), not_null("category")],
    "dim_user": [not_null("user_id"), not_null("user_name")],
    "dim_rating": [not_null("rating")],
    "fact_product_rating": [
        not_null("product_id"),
        unique("product_id"),
        not_null("product_name"),
        broken("between", "avg_rating", "avg_rating < 0 OR avg_rating > 3"),
    ],
    "fact_sales_category": [
        not_null("user_id"),
        references("user_id", "dim_user", "user_id"),
        not_null("category"),
        not_null("sales_amount"),
        broken("non_negative", "sales_amount", "sales_amount < 0"),
    ],
}

EXPECTATION_CHECKS = {
    "dim_product": [
        rows("{v} BETWEEN 100 AND 100000"),
        schema("columns_set"),
        schema("column_count", observed="6"),
        not_null("product_id"),
        not_null("product_name"),
        broken("length_between", "product_name", "length(product_name) NOT BETWEEN 1 AND 10000"),
        not_null("category"),
    ],
    "dim_rating": [
        schema("column_count", observed="4"),
        rows("{v} BETWEEN 100 AND 1000000"),
        schema("columns_set"),
        not_null("user_id"),
        not_null("product_id"),
        not_null("rating"),
    ],
    "dim_user": [
        schema("column_count", observed="2"),
        rows("{v} BETWEEN 100 AND 1000000"),
        schema("columns_set"),
        not_null("user_id"),
        not_null("user_name"),
        broken("length_between", "user_name", "length(user_name) NOT BETWEEN 1 AND 10000"),
    ],
    "fact_product_rating": [
        rows("{v} BETWEEN 10 AND 1000000"),
        schema("column_count", observed="3"),
        schema("columns_set"),
        not_null("product_id"),
        unique("product_id"),
        not_null("product_name"),
        broken("length_between", "product_name", "length(product_name) NOT BETWEEN 1 AND 10000"),
        broken("between", "avg_rating", "avg_rating < 0 OR avg_rating > 5"),
        not_null("avg_rating"),
    ],
    "fact_sales_category": [
        rows("{v} BETWEEN 10 AND 1000000"),
        schema("column_count", observed="3"),
        schema("columns_set"),
        not_null("user_id"),
        not_null("category"),
        distinct_between("category", 1, 100000),
        not_null("sales_amount"),
        broken("between", "sales_amount", "sales_amount < 0 OR sales_amount > 1000000"),
    ],
}


def _typed(*columns: str) -> list:
    return [schema("field_type", c) for c in columns]


QUALITY_CHECKS = {
    "dim_product": [
        *_typed("product_id", "product_name", "category", "about_product", "img_link", "product_link"),
        number_within("SELECT COUNT(*) FROM dim_product", "{v} > 1000"),
    ],
    "dim_rating": [
        *_typed("user_id", "product_id", "rating", "rating_count"),
        # Spark's mean of a decimal(3,2) is a decimal(7,6).
        number_within(
            "SELECT CAST(SUM(CAST(rating AS DECIMAL(18,2))) / COUNT(rating) AS DECIMAL(7,6)) FROM dim_rating",
            "{v} BETWEEN 0 AND 5",
        ),
    ],
    "dim_user": [
        *_typed("user_id", "user_name"),
        number_within("SELECT COUNT(*) FROM dim_user", "{v} > 1000"),
    ],
    "fact_product_rating": [
        *_typed("product_id", "product_name", "avg_rating"),
        sql.rule(
            "contract_sql",
            None,
            unexpected="CASE WHEN lo >= 1 THEN 0 ELSE 1 END + CASE WHEN hi <= 5 THEN 0 ELSE 1 END",
            outcome=sql.either("lo >= 1 AND hi <= 5"),
            source="(SELECT MIN(avg_rating) AS lo, MAX(avg_rating) AS hi FROM {table}) AS q",
        ),
    ],
    "fact_sales_category": [
        *_typed("user_id", "category", "sales_amount"),
        number_within("SELECT COUNT(*) FROM fact_sales_category WHERE sales_amount < 0", "{v} = 0"),
    ],
}

_URI = r"NOT regexp_matches({c}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^\s]+$')"

FULL_CHECKS = {
    "dim_product": [
        schema("field_type", "product_id"),
        not_null("product_id"),
        unique("product_id"),
        schema("field_type", "product_name"),
        not_null("product_name"),
        schema("field_type", "category"),
        not_null("category"),
        schema("field_type", "about_product"),
        schema("field_type", "img_link"),
        broken("uri_format", "img_link", _URI.format(c="img_link")),
        schema("field_type", "product_link"),
        broken("uri_format", "product_link", _URI.format(c="product_link")),
        lacking("field_type", "product_descriptions"),
        lacking("uri_format", "product_descriptions"),
        rows("{v} BETWEEN 0 AND 5"),
    ],
    "dim_rating": [
        schema("field_type", "user_id"),
        not_null("user_id"),
        schema("field_type", "product_id"),
        not_null("product_id"),
        references("product_id", "dim_product", "product_id"),
        schema("field_type", "rating"),
        not_null("rating"),
        schema("field_type", "rating_count"),
        unique("user_id, product_id", "compound_unique"),
        references("product_id", "fact_product_rating", "product_id"),
    ],
    "dim_user": [
        schema("field_type", "user_id"),
        not_null("user_id"),
        unique("user_id"),
        schema("field_type", "user_name"),
        rows("{v} > 500000"),
    ],
    "fact_product_rating": [
        schema("field_type", "product_id"),
        references("product_id", "dim_product", "product_id"),
        schema("field_type", "product_name"),
        schema("field_type", "avg_rating"),
    ],
    "fact_sales_category": [
        schema("field_type", "user_id"),
        references("user_id", "dim_user", "user_id"),
        schema("field_type", "category"),
        schema("field_type", "sales_amount"),
        references("category", "dim_product", "category"),
    ],
}

# --------------------------------------------------------------------------- registration

QUERIES = {
    "suite_obt": suite_obt,
    "scan_obt": scan_obt,
    "scan_dims": _scan_folder(rs.DIM_SCANS),
    "scan_facts": _scan_folder(rs.FACT_SCANS),
    "suite_summary": suite_summary,
    "suite_from_json": suite_from_json,
    "results_suite": results_suite,
    "results_union": results_union,
    "results_scan": results_scan,
    "contract_quality": contract_quality,
    "contract_full": contract_full,
}

_DIALECTS = {
    "ruleset": (rs.DIM_RULESETS | rs.FACT_RULESETS, RULESET_CHECKS),
    "suite": (rs.SUITES, SUITE_CHECKS),
    "scan": (rs.DIM_SCANS | rs.FACT_SCANS, DIM_SCAN_CHECKS | FACT_SCAN_CHECKS),
    "tests": (rs.MODEL_TESTS, TEST_CHECKS),
    "expectations": (rs.MODEL_EXPECTATIONS, EXPECTATION_CHECKS),
}

ORACLES = {
    "suite_obt": sql.with_tables("obt_sales", sql.all_of("obt_sales", OBT_SUITE_CHECKS)),
    "scan_obt": sql.with_tables("obt_sales", sql.all_of("obt_sales", OBT_SCAN_CHECKS)),
    "scan_dims": sql.with_tables(
        list(DIM_SCAN_CHECKS),
        "\nUNION ALL ".join(sql.all_of(t, checks, f"scan_{t}") for t, checks in DIM_SCAN_CHECKS.items()),
    ),
    "scan_facts": sql.with_tables(
        list(FACT_SCAN_CHECKS),
        "\nUNION ALL ".join(sql.all_of(t, checks, f"scan_{t}") for t, checks in FACT_SCAN_CHECKS.items()),
    ),
}

for _dialect, (_rules, _checks) in _DIALECTS.items():
    for _table in TABLES:
        # The suite written for the other fact finds none of its columns and so reads no data.
        if (_dialect, _table) != ("suite", "fact_sales_category"):
            QUERIES[f"{_dialect}_{_table}"] = _on_table(_table, _rules[_table])
            ORACLES[f"{_dialect}_{_table}"] = sql.with_tables(
                [_table, "dim_user"], sql.all_of(_table, _checks[_table])
            )




_HELD = "count(*) FILTER (WHERE outcome <> 'fail')"

ORACLES["suite_summary"] = sql.with_tables(
    "dim_product",
    f"""SELECT count(*) AS evaluated, {_HELD} AS successful, count(*) - {_HELD} AS unsuccessful,
 CAST(100 AS DOUBLE) * {_HELD} / count(*) AS success_percent, bool_and(outcome <> 'fail') AS success
FROM ({sql.all_of("dim_product", SUITE_CHECKS["dim_product"])})""",
)
ORACLES["suite_from_json"] = sql.with_tables(
    "dim_user",
    f"""SELECT position, rule, outcome <> 'fail' AS success,
 CAST(100 AS DOUBLE) * {_HELD} OVER () / count(*) OVER () AS success_percent
FROM ({sql.all_of("dim_user", SUITE_CHECKS["dim_user"])})""",
)

_SUITE_ROWS = f"""SELECT '{RUN_NAME}' AS run_name, '{RUN_TIME}' AS validation_time, context AS data_asset_name,
 CASE rule WHEN 'column_exists' THEN 'expect_column_to_exist'
  WHEN 'not_null' THEN 'expect_column_values_to_not_be_null'
  WHEN 'unique' THEN 'expect_column_values_to_be_unique'
  WHEN 'length_between' THEN 'expect_column_value_lengths_to_be_between'
  WHEN 'matches' THEN 'expect_column_values_to_match_regex'
  WHEN 'between' THEN 'expect_column_values_to_be_between' END AS expectation_type,
 coalesce("column", 'N/A') AS "column", outcome <> 'fail' AS success,
 coalesce(element_count, 0) AS element_count, coalesce(unexpected_count, 0) AS unexpected_count,
 CAST(100 AS DOUBLE) * {_HELD} OVER (PARTITION BY context) / count(*) OVER (PARTITION BY context) AS success_percent
FROM ({{outcomes}})"""

ORACLES["results_suite"] = sql.with_tables(
    "dim_product",
    _SUITE_ROWS.format(outcomes=sql.all_of("dim_product", SUITE_CHECKS["dim_product"], "dim_product")),
)
ORACLES["results_union"] = sql.with_tables(
    list(TABLES),
    _SUITE_ROWS.format(outcomes="\nUNION ALL ".join(sql.all_of(t, SUITE_CHECKS[t], t) for t in TABLES)),
)

# Position, definition and metrics of each check of the rating scan.
_SCAN_TEXTS = [
    (1, "columns ['user_id', 'product_id', 'rating', 'rating_count'] exist", ["schema"]),
    (2, "missing_count(user_id), fail when > 0", ["missing_count"]),
    (3, "missing_count(product_id), fail when > 0", ["missing_count"]),
    (4, "duplicate_count(user_id, product_id), warn when > 0", ["duplicate_count"]),
    (5, "invalid_percent(rating with min=0, max=5), warn when > 5%, fail when > 10%", ["invalid_count", "row_count"]),
    (6, "missing_percent(rating), warn when > 10%", ["missing_count", "row_count"]),
    (7, "invalid_percent(rating_count with min=0), warn when > 5%, fail when > 10%", ["invalid_count", "row_count"]),
    (8, "missing_percent(rating_count), warn when > 10%", ["missing_count", "row_count"]),
]
_SCAN_VALUES = ", ".join(f"({p}, {sql.text(d)}, {sql.text(m)})" for p, d, ms in _SCAN_TEXTS for m in ms)
ORACLES["results_scan"] = sql.with_tables(
    "dim_rating",
    f"""SELECT definition AS name, rule AS type, definition, 'sales' AS "dataSource", 'dim_rating' AS "table",
 '' AS filter, coalesce("column", '') AS "column", outcome,
 concat_ws('-', 'metric', 'sales', 'dim_rating', "column", metric) AS metric, '{SCAN_TIME}' AS datetime
FROM ({sql.all_of("dim_rating", DIM_SCAN_CHECKS["dim_rating"])})
JOIN (VALUES {_SCAN_VALUES}) AS v(position, definition, metric) USING (position)""",
)
ORACLES["contract_quality"] = sql.with_tables(
    list(TABLES), "\nUNION ALL ".join(sql.all_of(t, checks, t) for t, checks in QUALITY_CHECKS.items())
)
ORACLES["contract_full"] = sql.with_tables(
    list(TABLES), "\nUNION ALL ".join(sql.all_of(t, checks, t) for t, checks in FULL_CHECKS.items())
)
