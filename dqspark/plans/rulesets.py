"""The rule lists of the warehouse tables, one dictionary per dialect they were written in.

Fixed values throughout: columns, bounds, patterns and thresholds are those the checks must use.
"""

from __future__ import annotations

from dqspark.operators.contract import Contract
from dqspark.operators.rules import (
    Rule,
    between,
    column_count,
    column_exists,
    columns_ordered,
    columns_set,
    compound_unique,
    custom_sql,
    data_type,
    distinct_between,
    duplicate_count,
    invalid,
    length_between,
    matches,
    metric_max,
    metric_min,
    missing,
    non_negative,
    not_null,
    of_type,
    references,
    required_columns,
    row_count,
    row_count_between,
    sql_metric,
    unique,
    uniqueness,
)
from dqspark.operators.suites import rules_from_suite
from dqspark.plans.columns import (
    DIM_PRODUCT,
    DIM_RATING,
    DIM_USER,
    FACT_PRODUCT_RATING,
    FACT_SALES_CATEGORY,
    SALES_TYPES,
)

# ------------------------------------------------------------------ rulesets run by the refresh

DIM_RULESETS: dict[str, list[Rule]] = {
    "dim_user": [
        column_exists("user_id"),
        column_exists("user_name"),
        not_null("user_id"),
        not_null("user_name"),
        uniqueness("user_id", "> 0.99"),
        row_count("> 0"),
        data_type("user_id", "int"),
        data_type("user_name", "string"),
    ],
    "dim_product": [
        *[column_exists(c) for c in DIM_PRODUCT],
        *[not_null(c) for c in DIM_PRODUCT if c != "about_product"],
        uniqueness("product_id", "> 0.99"),
        *[data_type(c, "string") for c in DIM_PRODUCT],
    ],
    "dim_rating": [
        *[column_exists(c) for c in DIM_RATING],
        *[not_null(c) for c in DIM_RATING],
        data_type("user_id", "string"),
        data_type("product_id", "string"),
        data_type("rating", "float"),
        data_type("rating_count", "int"),
        row_count("> 0"),
    ],
}

FACT_RULESETS: dict[str, list[Rule]] = {
    "fact_product_rating": [
        *[column_exists(c) for c in FACT_PRODUCT_RATING],
        *[not_null(c) for c in FACT_PRODUCT_RATING],
        data_type("product_id", "string"),
        data_type("product_name", "string"),
        data_type("avg_rating", "float"),
        row_count("> 0"),
        custom_sql("SELECT avg_rating FROM primary WHERE avg_rating > 5"),
    ],
    "fact_sales_category": [
        *[column_exists(c) for c in FACT_SALES_CATEGORY],
        *[not_null(c) for c in FACT_SALES_CATEGORY],
        data_type("user_id", "string"),
        data_type("category", "string"),
        data_type("sales_amount", "float"),
        row_count("> 0"),
    ],
}

# ------------------------------------------------------------------ suites, in their JSON form


def _expect(kind: str, **kwargs) -> dict:
    return {"expectation_type": kind, "kwargs": kwargs}


_AVG_RATING_SUITE = {
    "expectations": [
        _expect("expect_column_to_exist", column="product_id"),
        _expect("expect_column_values_to_not_be_null", column="product_id"),
        _expect("expect_column_to_exist", column="product_name"),
        _expect("expect_column_values_to_not_be_null", column="product_name"),
        _expect("expect_column_value_lengths_to_be_between", column="product_name", min_value=3),
        _expect("expect_column_to_exist", column="avg_rating"),
        _expect("expect_column_values_to_be_between", column="avg_rating", min_value=0.0, max_value=5.0, mostly=1.0),
    ]
}

SUITE_DICTS: dict[str, dict] = {
    "dim_product": {
        "expectations": [
            _expect("expect_column_to_exist", column="product_id"),
            _expect("expect_column_values_to_not_be_null", column="product_id"),
            _expect("expect_column_values_to_be_unique", column="product_id"),
            _expect("expect_column_values_to_not_be_null", column="product_name"),
            _expect("expect_column_values_to_not_be_null", column="category"),
            _expect("expect_column_value_lengths_to_be_between", column="about_product", min_value=10),
            _expect("expect_column_values_to_match_regex", column="img_link", regex="http[s]?://.*", mostly=0.9),
            _expect("expect_column_values_to_match_regex", column="product_link", regex="http[s]?://.*", mostly=0.9),
        ]
    },
    "dim_rating": {
        "expectations": [
            _expect("expect_column_to_exist", column="user_id"),
            _expect("expect_column_values_to_not_be_null", column="user_id"),
            _expect("expect_column_to_exist", column="product_id"),
            _expect("expect_column_values_to_not_be_null", column="product_id"),
            _expect("expect_column_to_exist", column="rating"),
            _expect("expect_column_values_to_be_between", column="rating", min_value=0.0, max_value=5.0),
            _expect("expect_column_to_exist", column="rating_count"),
            _expect("expect_column_values_to_be_between", column="rating_count", min_value=0),
        ]
    },
    "dim_user": {
        "expectations": [
            _expect("expect_column_to_exist", column="user_id"),
            _expect("expect_column_values_to_not_be_null", column="user_id"),
            _expect("expect_column_values_to_be_unique", column="user_id"),
            _expect("expect_column_to_exist", column="user_name"),
            _expect("expect_column_values_to_not_be_null", column="user_name"),
            _expect("expect_column_value_lengths_to_be_between", column="user_name", min_value=3),
        ]
    },
    "fact_product_rating": _AVG_RATING_SUITE,
    # Written for the columns of the other fact: on this table all of it fails.
    "fact_sales_category": _AVG_RATING_SUITE,
}

SUITES: dict[str, list[Rule]] = {name: rules_from_suite(suite) for name, suite in SUITE_DICTS.items()}

OBT_SUITE: list[Rule] = [
    columns_ordered(list(SALES_TYPES)),
    unique("product_id"),
    not_null("product_id"),
    between("discount_percentage", 0, 100),
    between("rating", 0, 5),
    between("actual_price", 0.01),
    between("discounted_price", 0.01),
    between("rating_count", 0),
    of_type("rating_count", "IntegerType"),
    matches("product_link", r"^https:\/\/www\.[a-zA-Z0-9\-\.]+\.[a-zA-Z]{2,}$", mostly=0.9),
    matches("img_link", r"^https:\/\/.*\.(jpg|jpeg|png|webp)$"),
    matches("review_id", r"^[a-zA-Z0-9_-]+$"),
    matches("user_id", r"^[a-zA-Z0-9_-]+$"),
    matches("product_id", r"^[a-zA-Z0-9_-]+$"),
    length_between("review_title", 3, 100),
    compound_unique(["product_id", "product_name"]),
]

# ------------------------------------------------------------------ scans, with two levels

DIM_SCANS: dict[str, list[Rule]] = {
    "dim_product": [
        required_columns(DIM_PRODUCT),
        missing("product_id", fail="> 0"),
        missing("product_name", fail="> 0"),
        duplicate_count(["product_id"], warn="> 0"),
        invalid(
            "category",
            values=["Electronics", "Books", "Clothing", "Toys", "Home", "Beauty"],
            warn="> 5%",
            fail="> 10%",
        ),
        invalid("img_link", regex=r"^https?://.*\.(jpg|jpeg|png|gif)$", fail="> 0"),
        invalid("product_link", regex=r"^https?://.*$", fail="> 0"),
        missing("about_product", warn="> 10%"),
    ],
    "dim_rating": [
        required_columns(DIM_RATING),
        missing("user_id", fail="> 0"),
        missing("product_id", fail="> 0"),
        duplicate_count(["user_id", "product_id"], warn="> 0"),
        invalid("rating", min=0, max=5, warn="> 5%", fail="> 10%"),
        missing("rating", warn="> 10%"),
        invalid("rating_count", min=0, warn="> 5%", fail="> 10%"),
        missing("rating_count", warn="> 10%"),
    ],
    "dim_user": [
        required_columns(DIM_USER),
        missing("user_id", fail="> 0"),
        duplicate_count(["user_id"], warn="> 0"),
        missing("user_name", warn="> 5%", fail="> 10%"),
        invalid("user_name", regex=r"^[A-Za-zÀ-ÖØ-öø-ÿ\s''-]+$", warn="> 5%", fail="> 10%"),
    ],
}

FACT_SCANS: dict[str, list[Rule]] = {
    "fact_product_rating": [
        required_columns(FACT_PRODUCT_RATING),
        missing("product_id", fail="> 0"),
        missing("product_name", fail="> 0"),
        metric_min("avg_rating", warn="< 0", fail="< 0"),
        metric_max("avg_rating", warn="> 5", fail="> 5"),
        sql_metric(
            "rating_negativo", "SELECT COUNT(*) FROM fact_product_rating WHERE avg_rating < 0", fail="> 0"
        ),
        sql_metric(
            "nome_em_branco",
            "SELECT COUNT(*) FROM fact_product_rating WHERE TRIM(product_name) = ''",
            warn="> 0",
        ),
    ],
    "fact_sales_category": [
        required_columns(FACT_SALES_CATEGORY),
        missing("user_id", fail="> 0"),
        missing("category", fail="> 0"),
        missing("sales_amount", warn="> 5%"),
        metric_min("sales_amount", fail="< 0"),
        sql_metric(
            "sales_amount_outlier",
            "SELECT COUNT(*) FROM fact_sales_category WHERE sales_amount > 100000",
            warn="> 0",
        ),
        sql_metric(
            "venda_sem_categoria",
            "SELECT COUNT(*) FROM fact_sales_category WHERE category IS NULL AND sales_amount IS NOT NULL",
            fail="> 0",
        ),
    ],
}

OBT_SCAN: list[Rule] = [
    required_columns(list(SALES_TYPES)),
    missing("product_id", fail="> 0"),
    missing("product_name", fail="> 0"),
    duplicate_count(["product_id"], warn="> 0"),
    missing("discounted_price", warn="> 10%"),
    missing("actual_price", warn="> 10%"),
    missing("discount_percentage", warn="> 10%"),
    missing("rating", warn="> 20%"),
    missing("rating_count", warn="> 20%"),
    invalid("discount_percentage", fail=">= 100"),
    metric_min("discounted_price", fail="<= 0"),
    metric_min("actual_price", fail="<= 0"),
    invalid("rating", fail=("< 0", "> 5")),
    duplicate_count(["review_id"], fail="> 0"),
    invalid("discounted_price", kind="decimal", fail="> 5%"),
    invalid("actual_price", kind="decimal", fail="> 5%"),
    invalid("discount_percentage", kind="decimal", fail="> 5%"),
    invalid("rating", kind="decimal", fail="> 5%"),
    invalid("rating_count", kind="integer", fail="> 5%"),
    invalid("product_id", kind="integer", fail="> 5%"),
    invalid("user_id", kind="integer", fail="> 5%"),
    invalid("review_id", kind="integer", fail="> 5%"),
]

# ------------------------------------------------------------------ tests run after each model

MODEL_TESTS: dict[str, list[Rule]] = {
    "dim_product": [not_null("product_id"), not_null("product_name"), not_null("category")],
    "dim_user": [not_null("user_id"), not_null("user_name")],
    "dim_rating": [not_null("rating")],
    "fact_product_rating": [
        not_null("product_id"),
        unique("product_id"),
        not_null("product_name"),
        between("avg_rating", 0, 3),
    ],
    "fact_sales_category": [
        not_null("user_id"),
        references("user_id", "dim_user", "user_id"),
        not_null("category"),
        not_null("sales_amount"),
        non_negative("sales_amount"),
    ],
}

MODEL_EXPECTATIONS: dict[str, list[Rule]] = {
    "dim_product": [
        row_count_between(100, 100000),
        columns_set(DIM_PRODUCT),
        column_count(6),
        not_null("product_id"),
        not_null("product_name"),
        length_between("product_name", 1, 10000),
        not_null("category"),
    ],
    "dim_rating": [
        column_count(4),
        row_count_between(100, 1000000),
        columns_set(DIM_RATING),
        not_null("user_id"),
        not_null("product_id"),
        not_null("rating"),
    ],
    "dim_user": [
        column_count(2),
        row_count_between(100, 1000000),
        columns_set(DIM_USER),
        not_null("user_id"),
        not_null("user_name"),
        length_between("user_name", 1, 10000),
    ],
    "fact_product_rating": [
        row_count_between(10, 1000000),
        column_count(3),
        columns_set(FACT_PRODUCT_RATING),
        not_null("product_id"),
        unique("product_id"),
        not_null("product_name"),
        length_between("product_name", 1, 10000),
        between("avg_rating", 0, 5),
        not_null("avg_rating"),
    ],
    "fact_sales_category": [
        row_count_between(10, 1000000),
        column_count(3),
        columns_set(FACT_SALES_CATEGORY),
        not_null("user_id"),
        not_null("category"),
        distinct_between("category", 1, 100000),
        not_null("sales_amount"),
        between("sales_amount", 0, 1000000),
    ],
}

# ------------------------------------------------------------------ contracts, in their file form

_TEXT = {"type": "string"}
_RATING = {"type": "decimal", "precision": 3, "scale": 2}
_AMOUNT = {"type": "decimal", "precision": 20, "scale": 2}

_FIELDS = {
    "dim_product": {c: _TEXT for c in DIM_PRODUCT},
    "dim_rating": {"user_id": _TEXT, "product_id": _TEXT, "rating": _RATING, "rating_count": {"type": "bigint"}},
    "dim_user": {c: _TEXT for c in DIM_USER},
    "fact_product_rating": {"product_id": _TEXT, "product_name": _TEXT, "avg_rating": {"type": "double"}},
    "fact_sales_category": {"user_id": _TEXT, "category": _TEXT, "sales_amount": _AMOUNT},
}

QUALITY_CONTRACT = Contract.from_dict(
    {
        "models": {
            "dim_product": {
                "fields": _FIELDS["dim_product"],
                "quality": [
                    {
                        "type": "sql",
                        "query": "SELECT COUNT(*) AS row_count FROM dim_product",
                        "mustBeGreaterThan": 1000,
                    }
                ],
            },
            "dim_rating": {
                "fields": _FIELDS["dim_rating"],
                "quality": [
                    {
                        "type": "sql",
                        "query": "SELECT AVG(rating) AS avg_rating FROM dim_rating",
                        "mustBeBetween": [0, 5],
                    }
                ],
            },
            "dim_user": {
                "fields": _FIELDS["dim_user"],
                "quality": [
                    {
                        "type": "sql",
                        "query": "SELECT COUNT(*) AS row_count FROM dim_user",
                        "mustBeGreaterThan": 1000,
                    }
                ],
            },
            "fact_product_rating": {
                "fields": _FIELDS["fact_product_rating"],
                "quality": [
                    {
                        "type": "sql",
                        "query": "SELECT MIN(avg_rating) AS min_rating, MAX(avg_rating) AS max_rating "
                        "FROM fact_product_rating",
                        "mustSatisfy": ["min_rating >= 1.0", "max_rating <= 5.0"],
                    }
                ],
            },
            "fact_sales_category": {
                "fields": _FIELDS["fact_sales_category"],
                "quality": [
                    {
                        "type": "sql",
                        "query": "SELECT COUNT(*) AS negative_sales FROM fact_sales_category "
                        "WHERE sales_amount < 0",
                        "mustBeEqualTo": 0,
                    }
                ],
            },
        }
    }
)

FULL_CONTRACT = Contract.from_dict(
    {
        "models": {
            "dim_product": {
                "fields": {
                    "product_id": _TEXT | {"required": True, "unique": True, "primaryKey": True},
                    "product_name": _TEXT | {"required": True},
                    "category": _TEXT | {"required": True},
                    "about_product": _TEXT,
                    "img_link": _TEXT | {"format": "uri"},
                    "product_link": _TEXT | {"format": "uri"},
                    "product_descriptions": _TEXT | {"format": "uri"},
                },
                "quality": [
                    {
                        "type": "custom",
                        "implementation": _expect("expect_table_row_count_to_be_between", min_value=0, max_value=5),
                    }
                ],
            },
            "dim_rating": {
                "fields": {
                    "user_id": _TEXT | {"required": True},
                    "product_id": _TEXT | {"required": True, "references": "dim_product.product_id"},
                    "rating": _RATING | {"required": True},
                    "rating_count": {"type": "bigint"},
                },
                "primaryKey": ["user_id", "product_id"],
            },
            "dim_user": {
                "fields": {
                    "user_id": _TEXT | {"required": True, "unique": True, "primaryKey": True},
                    "user_name": _TEXT,
                },
                "quality": [
                    {
                        "type": "custom",
                        "implementation": {"type": "row_count", "must_be_greater_than": 500000},
                    }
                ],
            },
            "fact_product_rating": {
                "fields": _FIELDS["fact_product_rating"]
                | {"product_id": _TEXT | {"references": "dim_product.product_id"}}
            },
            "fact_sales_category": {
                "fields": _FIELDS["fact_sales_category"]
                | {"user_id": _TEXT | {"references": "dim_user.user_id"}}
            },
        },
        "relationships": [
            {
                "from": {"model": "fact_product_rating", "field": "product_id"},
                "to": {"model": "dim_product", "field": "product_id"},
            },
            {
                "from": {"model": "fact_sales_category", "field": "category"},
                "to": {"model": "dim_product", "field": "category"},
            },
            {
                "from": {"model": "fact_sales_category", "field": "user_id"},
                "to": {"model": "dim_user", "field": "user_id"},
            },
            {
                "from": {"model": "dim_rating", "field": "product_id"},
                "to": {"model": "dim_product", "field": "product_id"},
            },
            {
                "from": {"model": "dim_rating", "field": "product_id"},
                "to": {"model": "fact_product_rating", "field": "product_id"},
            },
        ],
    }
)
