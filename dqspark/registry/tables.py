"""Sources, staging, dimensions, facts, upserts, and the refresh of the whole warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqspark.functions.clean import is_blank
from dqspark.operators.contract import Contract, test_contract as run_contract
from dqspark.operators.evaluate import CheckFailed, evaluate, failing_rows, union_results, validate
from dqspark.operators.rules import between, matches, metric_min, not_null, references, row_count, unique
from dqspark.operators.violations import orphans, violations_below, violations_between, violations_null
from dqspark.plans import warehouse as w
from dqspark.plans.changes import refresh_changes
from dqspark.plans.rulesets import MODEL_TESTS, OBT_SCAN
from dqspark.registry import sql
from dqspark.registry.results import OUTCOME_COLUMNS
from dqspark.registry.suites import OBT_SCAN_CHECKS, RULESET_CHECKS, TEST_CHECKS
from dqspark.session import scratch_path
from dqspark.sources.buckets import upsert_buckets
from dqspark.sources.readers import (
    load_tables,
    read_catalog,
    read_csv,
    read_table,
    register,
    register_results,
)
from dqspark.registry.inputs import given, raw_sales, scan_rows
from dqspark.sources.writers import (
    append_results,
    ensure_namespace,
    ensure_table,
    insert_overwrite,
    materialize,
    upsert,
    write_csv,
)



def last_review():
    return [F.col("review_id").desc_nulls_last()]


def stg_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.cast_columns(raw_sales(spark, sf_dir))


def csv_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales as a CSV file, read back as text and staged.

    Plain, the file takes more disk than all shuffles before it, which are still there while it is written.
    """
    path = scratch_path(spark, "sales-csv")
    write_csv(raw_sales(spark, sf_dir), path, "gzip")
    return w.cast_columns(read_csv(spark, path, w.RAW_SCHEMA))


def stg_sales_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.build_stg(raw_sales(spark, sf_dir), last_review())


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.dim_product(raw_sales(spark, sf_dir))


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.dim_user(raw_sales(spark, sf_dir))


def dim_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.dim_rating(raw_sales(spark, sf_dir))


def dim_rating_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.dim_rating(raw_sales(spark, sf_dir), parse=False)


def fact_product_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_sales(spark, sf_dir)
    return w.fact_product_rating(raw, w.dim_product(raw), w.dim_rating(raw))


def fact_product_rating_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From ratings left as text: those with a decimal comma do not count."""
    raw = raw_sales(spark, sf_dir)
    fact = w.fact_product_rating(raw, w.dim_product(raw), w.dim_rating(raw, parse=False))
    return fact.withColumn("avg_rating", F.round("avg_rating", 6))


def fact_sales_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_sales(spark, sf_dir)
    return w.fact_sales_category(raw, w.dim_product(raw), w.dim_user(raw))


def stg_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged rows under a name, inlined into the SQL that uses them."""
    register(stg_sales(spark, sf_dir), "stg_sales_view")
    return spark.sql(
        "SELECT category, count(*) AS sales, max(actual_price) AS top_price, count(rating) AS rated "
        "FROM stg_sales_view GROUP BY category"
    )


def load_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tables by name; their sizes, with columns counted from the schema."""
    tables = load_tables(spark, sf_dir, ["orders", "customer", "part", "lineitem"], suffix=".parquet")
    return union_results(
        [
            df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")).withColumn(
                "n_columns", F.lit(len(df.columns)).cast("bigint")
            )
            for name, df in tables.items()
        ]
    )


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are the table; all orders, with a changed price, arrive as the source."""
    orders = given(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    upsert(orders.filter("o_orderstatus = 'F'"), path, ["o_orderkey"])
    return upsert(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, ["o_orderkey"])


def upsert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert on a key of two columns that the source repeats; the dearest line survives."""
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    path, keys = scratch_path(spark, "lines"), ["l_orderkey", "l_linenumber"]
    dearest = [F.desc("l_extendedprice")]
    upsert(lines.filter("l_quantity >= 25").withColumn("l_quantity", F.lit(0.0)), path, keys, dearest)
    return upsert(lines.filter("l_quantity <= 30"), path, keys, dearest)


def upsert_buckets_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a table kept in hash buckets of the order."""
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    path, keys = scratch_path(spark, "lines"), ["l_orderkey", "l_linenumber"]
    dearest, by = [F.desc("l_extendedprice")], ["l_orderkey"]
    upsert_buckets(lines.filter("l_quantity >= 25").withColumn("l_quantity", F.lit(0.0)), path, keys, dearest, by, buckets=8)
    return upsert_buckets(lines.filter("l_quantity <= 30"), path, keys, dearest, by).table


def upsert_kept_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are the table; all orders arrive without status and date, which the finished ones keep."""
    orders = given(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders")
    upsert_buckets(orders.filter("o_orderstatus = 'F'"), path, ["o_orderkey"], buckets=8)
    dearer = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1).drop("o_orderstatus", "o_orderdate")
    return upsert_buckets(dearer, path, ["o_orderkey"]).table


def upsert_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that has gained a column: open orders arrive with one, and finished ones have none."""
    orders, path = given(spark, sf_dir, "orders"), scratch_path(spark, "orders")
    upsert(orders, path, ["o_orderkey"])
    wider = orders.filter("o_orderstatus <> 'F'").withColumn("checked", F.lit("yes"))
    return upsert(wider, path, ["o_orderkey"], add_columns=True)


def orphans_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text keys with junk against a parent's numbers: the rows, and what the rule counts."""
    child = given(spark, sf_dir, "orders").select(
        F.concat(F.lit(" "), F.col("o_custkey"), F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise("")).alias("custkey"),
        "o_orderkey",
    )
    parent = given(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0")
    rows = failing_rows(child, references("custkey", "customer", "c_custkey"), {"customer": parent})
    counted = evaluate(child, [references("custkey", "customer", "c_custkey")], "orders", {"customer": parent})
    return rows.withColumn("counted", F.lit(None).cast("long")).union(
        counted.select(F.lit(None), F.lit(None), "unexpected_count")
    )


def raised_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a suite that must hold names when it raises."""
    rules = [not_null("o_custkey"), metric_min("o_totalprice", must="> 1e9"), unique("o_custkey"), row_count("> 0")]
    try:
        validate(given(spark, sf_dir, "orders"), rules, raise_on_fail=True)
        names = []
    except CheckFailed as failed:
        names = str(failed).split(", ")
    return spark.createDataFrame([(name,) for name in names], "failed string")


_BOUNDS = [
    ("mustBe", "=", 10), ("mustNotBe", "!=", 10), ("mustBeEqualTo", "=", 1500), ("mustNotBeEqualTo", "!=", 1500),
    ("mustBeGreaterThan", ">", 0.00001), ("mustBeGreaterThanOrEqualTo", ">=", 1e20), ("mustBeLessThan", "<", 0),
    ("mustBeLessThanOrEqualTo", "<=", 1e20),
]
_COUNTED = "SELECT 100.0 * count(*) / 100 FROM customer"


def contract_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comparison a contract's SQL check may state, on one number."""
    checks = [{"type": "sql", "query": _COUNTED, bound: value} for bound, _, value in _BOUNDS]
    contract = Contract.from_dict({"models": {"customer": {"fields": {}, "quality": checks}}})
    found = run_contract({"customer": given(spark, sf_dir, "customer")}, contract)
    return found.select("position", "definition", "outcome")


def catalog_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from a frame's schema, filled, replaced by name, and read from the catalog."""
    path = scratch_path(spark, "catalog")
    namespace = "dq_" + path.rsplit("-", 1)[-1]
    ensure_namespace(spark, namespace, path)
    products, name = dim_product(spark, sf_dir), f"{namespace}.dim_product"
    ensure_table(products, name)
    insert_overwrite(products.filter("category IS NULL"), name)
    insert_overwrite(products.select(*reversed(products.columns)), name)
    return read_catalog(spark, name)


def materialized_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model written as a table twice: the second write replaces the first."""
    path = scratch_path(spark, "models")
    namespace = "dq_" + path.rsplit("-", 1)[-1]
    ensure_namespace(spark, namespace, path)
    users = dim_user(spark, sf_dir)
    materialize(users, f"{namespace}.dim_user")
    return materialize(users, f"{namespace}.dim_user")


def built_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model written as a table and then tested; a failing test does not stop the others."""
    path = scratch_path(spark, "models")
    namespace = "dq_" + path.rsplit("-", 1)[-1]
    ensure_namespace(spark, namespace, path)
    return w.build(dim_user(spark, sf_dir), f"{namespace}.dim_user", MODEL_TESTS["dim_user"]).select(
        *OUTCOME_COLUMNS
    )


def results_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows appended in two runs below one folder, found there and registered as tables."""
    path = scratch_path(spark, "results")
    rows = scan_rows(spark, sf_dir)
    append_results(rows.filter("outcome = 'fail'"), f"{path}/scan", "outcome")
    prefix = "dq_" + path.rsplit("-", 1)[-1] + "_"
    register_results(spark, path, prefix)
    append_results(rows.filter("outcome <> 'fail'"), f"{path}/scan", "outcome")
    (name,) = register_results(spark, path, prefix)
    return spark.table(name).groupBy("outcome", "table").agg(F.count(F.lit(1)).alias("n"))


def warehouse_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging to facts as written tables, with both rounds of checks; the outcomes."""
    out = scratch_path(spark, "warehouse")
    results = w.refresh(spark, raw_sales(spark, sf_dir), out, last_review())
    return results.select("context", *OUTCOME_COLUMNS)


def refreshed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per user and category as a table: a refresh with one category, then one with all."""
    out, raw = scratch_path(spark, "warehouse"), raw_sales(spark, sf_dir)
    w.refresh(spark, raw.filter("category = 'STANDARD'"), out, last_review())
    w.refresh(spark, raw, out, last_review())
    return read_table(spark, f"{out}/fact_sales_category", "snapshot")


#: Orders of these priorities come as the first increment, all others as the second.
_FIRST = ("1-URGENT", "2-HIGH")


def refreshed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per user and category kept up to date by change sets: some priorities first, then the others.

    Each increment's texts are made for the orders of its priorities alone. Making them once and writing them down takes longer.
    """
    out, raw = scratch_path(spark, "warehouse"), raw_sales(spark, sf_dir)
    first = F.coalesce(F.col("review_title").isin(*_FIRST), F.lit(False))
    for increment in (raw.filter(first), raw.filter(~first)):
        refresh_changes(spark, increment, out, last_review(), buckets=8, check=False)
    return read_table(spark, f"{out}/fact_sales_category", "buckets")


def obt_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One big table as a written table, then its scan."""
    out = scratch_path(spark, "obt")
    return w.refresh_obt(spark, raw_sales(spark, sf_dir), out, OBT_SCAN, order_by=last_review()).select(
        *OUTCOME_COLUMNS
    )


def null_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations_null(raw_sales(spark, sf_dir), "user_name").select("user_id", "review_id", "product_id")


def negative_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations_below(given(spark, sf_dir, "customer"), "c_acctbal", 0)


def ratings_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations_between(fact_product_rating(spark, sf_dir), "avg_rating", 2.2, 2.8)


def blank_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_product_rating(spark, sf_dir).filter(is_blank(F.col("product_name")))


def sales_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_sales_category(spark, sf_dir).filter(F.col("sales_amount") > 100000)


def sales_without_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_sales_category(spark, sf_dir).filter(
        F.col("category").isNull() & F.col("sales_amount").isNotNull()
    )


def orphans_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers in debt, when only the others are known."""
    customers = given(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return orphans(given(spark, sf_dir, "orders"), "o_custkey", customers, "c_custkey")


def duplicated_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that break a uniqueness rule."""
    sales = raw_sales(spark, sf_dir).select("review_id", "product_id", "user_id", "actual_price")
    return failing_rows(sales, unique("review_id"))


def failing_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that break a range, each with its value."""
    return failing_rows(given(spark, sf_dir, "lineitem"), between("l_discount", 0.02, 0.08))


def failing_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = raw_sales(spark, sf_dir).select("review_id", "img_link")
    return failing_rows(sales, matches("img_link", r"\.(jpg|jpeg|png|gif)$"))


def failing_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that caused no event."""
    events = given(spark, sf_dir, "events")
    return failing_rows(
        given(spark, sf_dir, "orders"), references("o_custkey", "events", "user_id"), {"events": events}
    )


QUERIES = {
    f.__name__: f
    for f in (
        fact_sales_category,
        fact_product_rating,
        fact_product_rating_raw,
        stg_sales,
        csv_stage,
        stg_sales_dedup,
        dim_product,
        dim_user,
        dim_rating,
        dim_rating_raw,
        stg_view_sql,
        load_by_name,
        upsert_orders,
        upsert_lines,
        upsert_new_column,
        upsert_buckets_lines,
        upsert_kept_columns,
        orphans_text,
        raised_rules,
        contract_bounds,
        catalog_overwrite,
        materialized_users,
        built_users,
        results_catalog,
        warehouse_refresh,
        obt_refresh,
        refreshed_sales,
        refreshed_changes,
        blank_names,
        sales_outliers,
        sales_without_category,
        orphans_orders,
        duplicated_reviews,
        failing_between,
        failing_matches,
        failing_references,
    )
} | {
    "violations_null": null_users,
    "violations_below": negative_balances,
    "violations_between": ratings_out_of_range,
}

# The tables a refresh builds: everything comes from the staged row of each product.
_REFRESHED = ",\n".join(
    [
        sql.RAW_SALES,
        sql.STG_SALES,
        sql.OBT_SALES,
        "dim_product AS (SELECT product_id, product_name, category, about_product, img_link, product_link FROM obt_sales)",
        # One row per user: in order of name.
        "dim_user AS (SELECT user_id, min(user_name) AS user_name FROM obt_sales GROUP BY user_id)",
        "dim_rating AS (SELECT user_id, product_id, TRY_CAST(rating AS DECIMAL(3,2)) AS rating, "
        "CAST(rating_count AS BIGINT) AS rating_count FROM obt_sales)",
        "fact_product_rating AS (SELECT product_id, product_name, CAST(rating AS DOUBLE) AS avg_rating "
        "FROM dim_product JOIN dim_rating USING (product_id))",
        "fact_sales_category AS (SELECT user_id, category, CAST(sum(CAST(actual_price AS DECIMAL(10,2))) AS DECIMAL(20,2)) "
        "AS sales_amount FROM obt_sales GROUP BY user_id, category)",
    ]
).replace(" AS (", " AS MATERIALIZED (")

_FIRST_ROWS = f"coalesce(review_title IN {_FIRST}, false)"


def _increment(name: str, condition: str) -> str:
    return sql.OBT_SALES.replace("obt_sales AS", f"{name} AS").replace("FROM stg_sales", f"FROM stg_sales WHERE {condition}")


def _sales_of(name: str, table: str) -> str:
    return (
        f"{name} AS (SELECT user_id, category, CAST(sum(CAST(actual_price AS DECIMAL(10,2))) AS DECIMAL(20,2)) "
        f"AS sales_amount FROM {table} GROUP BY user_id, category)"
    )


# Staged rows after each increment, the sales they give, and what the second left of the first's.
_CHANGED = ",\n".join(
    [
        sql.RAW_SALES,
        sql.STG_SALES,
        _increment("before_rows", _FIRST_ROWS),
        _increment("increment_rows", f"NOT {_FIRST_ROWS}"),
        "after_rows AS (SELECT * FROM increment_rows UNION ALL SELECT * FROM before_rows "
        "WHERE product_id NOT IN (SELECT product_id FROM increment_rows))",
        _sales_of("before_sales", "before_rows"),
        _sales_of("after_sales", "after_rows"),
    ]
).replace(" AS (", " AS MATERIALIZED (")

ORACLES = {
    "refreshed_changes": f"""WITH {_CHANGED}
SELECT * FROM after_sales UNION ALL SELECT * FROM before_sales b WHERE NOT EXISTS (SELECT 1 FROM after_sales a
 WHERE a.user_id = b.user_id AND a.category IS NOT DISTINCT FROM b.category)""",
    "upsert_kept_columns": """SELECT * REPLACE (o_totalprice + 1 AS o_totalprice,
 CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS o_orderstatus,
 CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS o_orderdate) FROM orders""",
    "stg_sales": sql.with_tables("stg_sales", "SELECT * FROM stg_sales"),
    "csv_stage": sql.with_tables("stg_sales", "SELECT * FROM stg_sales"),
    "stg_sales_dedup": sql.with_tables("obt_sales", "SELECT * FROM obt_sales"),
    "dim_product": sql.with_tables("dim_product", "SELECT * FROM dim_product"),
    "dim_user": sql.with_tables("dim_user", "SELECT * FROM dim_user"),
    "dim_rating": sql.with_tables("dim_rating", "SELECT * FROM dim_rating"),
    "dim_rating_raw": sql.with_tables(
        "raw_sales", "SELECT user_id, product_id, rating, rating_count FROM raw_sales"
    ),
    "fact_product_rating": sql.with_tables("fact_product_rating", "SELECT * FROM fact_product_rating"),
    "fact_product_rating_raw": sql.with_tables(
        "dim_product",
        """SELECT p.product_id, p.product_name, round(AVG(CASE WHEN regexp_full_match(r.rating, '[0-9.]+')
 THEN TRY_CAST(r.rating AS DOUBLE) END), 6) AS avg_rating
FROM dim_product p JOIN raw_sales r ON r.product_id = p.product_id GROUP BY p.product_id, p.product_name""",
    ),
    "fact_sales_category": sql.with_tables("fact_sales_category", "SELECT * FROM fact_sales_category"),
    "stg_view_sql": sql.with_tables(
        "stg_sales",
        "SELECT category, count(*) AS sales, max(actual_price) AS top_price, count(rating) AS rated "
        "FROM stg_sales GROUP BY category",
    ),
    "load_by_name": """SELECT 'orders' AS table_name, count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders
UNION ALL SELECT 'customer', count(*), 5 FROM customer
UNION ALL SELECT 'part', count(*), 6 FROM part
UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem""",
    "upsert_orders": "SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders",
    "upsert_lines": """WITH lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem),
target AS (SELECT * REPLACE (CAST(0 AS DOUBLE) AS l_quantity) FROM lines WHERE l_quantity >= 25
 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC, l_partkey) = 1),
source AS (SELECT * FROM lines WHERE l_quantity <= 30
 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice DESC, l_partkey, l_quantity) = 1)
SELECT * FROM source UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s
 WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)""",
    "upsert_new_column": "SELECT *, CASE WHEN o_orderstatus <> 'F' THEN 'yes' END AS checked FROM orders",
    "orphans_text": """WITH child AS (SELECT ' ' || o_custkey || CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE '' END AS custkey,
 o_custkey, o_orderkey FROM orders), bad AS (SELECT custkey, o_orderkey FROM child
 WHERE o_orderkey % 7 = 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0))
SELECT custkey, o_orderkey, CAST(NULL AS BIGINT) AS counted FROM bad UNION ALL SELECT NULL, NULL, count(*) FROM bad""",
    "raised_rules": """SELECT 'min(o_totalprice)' AS failed WHERE (SELECT min(o_totalprice) FROM orders) <= 1e9
UNION ALL SELECT 'unique(o_custkey)' WHERE EXISTS (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)
UNION ALL SELECT 'not_null(o_custkey)' WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey IS NULL)
UNION ALL SELECT 'row_count()' WHERE NOT EXISTS (SELECT 1 FROM orders)""",
    "contract_bounds": "\nUNION ALL ".join(
        f"SELECT {i} AS position, '{_COUNTED} must be {sign} {value}' AS definition, "
        f"CASE WHEN (SELECT count(*) FROM customer) {sign.replace('!=', '<>')} {value} THEN 'pass' ELSE 'fail' END AS outcome"
        for i, (_, sign, value) in enumerate(_BOUNDS, start=1)
    ),
    "catalog_overwrite": sql.with_tables("dim_product", "SELECT * FROM dim_product"),
    "materialized_users": sql.with_tables("dim_user", "SELECT * FROM dim_user"),
    "built_users": sql.with_tables("dim_user", sql.all_of("dim_user", TEST_CHECKS["dim_user"])),
    "failing_between": """SELECT *, l_discount AS invalid_value FROM lineitem
WHERE l_discount < CAST(0.02 AS DOUBLE) OR l_discount > CAST(0.08 AS DOUBLE)""",
    "failing_matches": sql.with_tables(
        "raw_sales",
        r"SELECT review_id, img_link FROM raw_sales WHERE NOT regexp_matches(img_link, '\.(jpg|jpeg|png|gif)$')",
    ),
    "failing_references": "SELECT * FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)",
    "results_catalog": """SELECT CASE event_type WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'warn' ELSE 'pass' END AS outcome,
 't' || CAST(user_id % 5 AS VARCHAR) AS "table", count(*) AS n FROM events GROUP BY 1, 2""",
    "warehouse_refresh": "WITH "
    + _REFRESHED
    + "\n"
    + "\nUNION ALL ".join(sql.all_of(name, checks, name) for name, checks in RULESET_CHECKS.items()),
    "refreshed_sales": f"WITH {_REFRESHED}\nSELECT * FROM fact_sales_category",
    "obt_refresh": sql.with_tables("obt_sales", sql.all_of("obt_sales", OBT_SCAN_CHECKS)),
    "violations_null": sql.with_tables(
        "raw_sales", "SELECT user_id, review_id, product_id FROM raw_sales WHERE user_name IS NULL"
    ),
    "violations_below": "SELECT * FROM customer WHERE c_acctbal < 0",
    "violations_between": sql.with_tables(
        "fact_product_rating",
        "SELECT *, avg_rating AS invalid_value FROM fact_product_rating WHERE avg_rating < 2.2 OR avg_rating > 2.8",
    ),
    "blank_names": sql.with_tables(
        "fact_product_rating", "SELECT * FROM fact_product_rating WHERE TRIM(product_name) = ''"
    ),
    "sales_outliers": sql.with_tables(
        "fact_sales_category", "SELECT * FROM fact_sales_category WHERE sales_amount > 100000"
    ),
    "sales_without_category": sql.with_tables(
        "fact_sales_category",
        "SELECT * FROM fact_sales_category WHERE category IS NULL AND sales_amount IS NOT NULL",
    ),
    "orphans_orders": """SELECT * FROM orders o WHERE NOT EXISTS
 (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal >= 0)""",
    "duplicated_reviews": sql.with_tables(
        "raw_sales",
        "SELECT review_id, product_id, user_id, actual_price FROM raw_sales "
        "QUALIFY count(*) OVER (PARTITION BY review_id) > 1",
    ),
}
ORACLES["upsert_buckets_lines"] = ORACLES["upsert_lines"]
