"""The warehouse refreshed by change sets: what an increment touches is recomputed, the rest is left where it is."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqspark.operators.dedup import dedup
from dqspark.operators.evaluate import RESULT_SCHEMA, evaluate_all, raise_if_failed
from dqspark.operators.rules import Rule
from dqspark.plans.columns import DIM_PRODUCT
from dqspark.plans.rulesets import DIM_RULESETS, FACT_RULESETS
from dqspark.plans.warehouse import (
    KEYS,
    RAW_SCHEMA,
    cast_columns,
    dim_rating,
    fact_product_rating,
    fact_sales_category,
    keep_outcomes,
    now,
)
from dqspark.session import stored
from dqspark.sources.buckets import Change, bucket_column, read_buckets, read_keys, upsert_buckets
from dqspark.sources.readers import read_csv

#: The sales again, by user: what dimensions and facts of users are computed from.
SALES_BY_USER = "sales_by_user"
_BY = {"dim_rating": ("product_id",), "fact_sales_category": ("user_id",), SALES_BY_USER: ("user_id",)}
_KEYS = KEYS | {SALES_BY_USER: ("user_id", "product_id")}


def _of(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the keys; NULL is a key."""
    wanted = keys.select(F.col(key).alias("_wanted"))
    return rows.join(wanted, F.col(key).eqNullSafe(F.col("_wanted")), "left_semi")


def _by_user(after: DataFrame, before: DataFrame) -> DataFrame:
    """A change as rows by user and product: those now there, and as ``gone`` those whose product went to another user."""
    columns = ["user_id", "product_id", "user_name", "category", "actual_price"]
    there = after.select(*columns, F.lit(False).alias("gone"))
    left = before.select(*columns, F.lit(True).alias("gone"))
    now_there = there.select(F.col("user_id").alias("_u"), F.col("product_id").alias("_p"))
    same = F.col("user_id").eqNullSafe(F.col("_u")) & F.col("product_id").eqNullSafe(F.col("_p"))
    return there.unionByName(left.join(now_there, same, "left_anti"))


def refresh_changes(
    spark: SparkSession,
    raw: DataFrame | str,
    out: str,
    order_by: Sequence[Column] = (),
    buckets: int = 64,
    dim_rulesets: Mapping[str, Sequence[Rule]] | None = None,
    fact_rulesets: Mapping[str, Sequence[Rule]] | None = None,
    check: bool = True,
    raise_on_fail: bool = False,
    run_name: str = "refresh_changes",
    multi_line: bool = False,
) -> DataFrame:
    """Staging, dimensions and facts after an increment ``raw``. Returns the outcomes of this run's checks.

    The tables are those of ``refresh`` after the same increments, kept in ``buckets`` hash buckets each
    (``read_buckets``), and one more, the sales by user. The increment's rows and the staged rows they replace name the
    products and users concerned; each table is computed for these alone, from the buckets in which they lie: products
    and ratings by product, users and their sales by user. Buckets without a change are neither read for that nor written.

    As in ``refresh`` rows are added and replaced, never deleted: a user or category without sales left keeps its last
    row. Checks, unless ``check`` is false, are on whole tables, as most rules are; they read and write nothing but
    outcomes. With ``raise_on_fail`` facts and staging are not built on dimensions that failed. An increment without rows
    changes nothing. Staging is written last; a run that died or raised is repeated with the same increment, before
    any other.
    """
    rows = read_csv(spark, raw, RAW_SCHEMA, multi_line) if isinstance(raw, str) else raw
    at = now()
    dim_rulesets = DIM_RULESETS if dim_rulesets is None else dim_rulesets
    fact_rulesets = FACT_RULESETS if fact_rulesets is None else fact_rulesets

    def save(name: str, df: DataFrame, unique: bool = False, order: Sequence[Column] = ()) -> Change:
        return upsert_buckets(df, f"{out}/{name}", _KEYS[name], order, _BY.get(name), buckets, unique)

    def among(name: str, keys: DataFrame, key: str) -> DataFrame:
        return _of(read_keys(spark, f"{out}/{name}", keys, [key]), keys, key)

    def checked(rulesets: Mapping[str, Sequence[Rule]]) -> DataFrame:
        tables = {
            name: read_buckets(spark, f"{out}/{name}") for name in KEYS if check and bucket_column(spark, f"{out}/{name}")
        }
        outcomes = evaluate_all(tables, {n: r for n, r in rulesets.items() if n in tables}).collect() if tables else []
        results = spark.createDataFrame(outcomes, f"context string, {RESULT_SCHEMA}").coalesce(1)
        keep_outcomes(results, out, run_name, at)
        return raise_if_failed(results) if raise_on_fail else results

    # Staging is written last: until then it holds what the increment replaces, so a run that dies can be repeated.
    after = stored(dedup(cast_columns(rows), KEYS["stg_sales"], order_by), "increment")
    if after.isEmpty():
        return checked(dim_rulesets).unionByName(checked(fact_rulesets))
    staged = bucket_column(spark, f"{out}/stg_sales") is not None
    before = stored(among("stg_sales", after, "product_id"), "replaced") if staged else after.limit(0)
    products = after.select("product_id")
    moved = save(SALES_BY_USER, _by_user(after, before), unique=True)
    users = stored(moved.after.select("user_id").distinct(), "users")
    sales = stored(among(SALES_BY_USER, users, "user_id").filter("NOT gone"), "user-sales")
    save("dim_product", after.select(*DIM_PRODUCT), unique=True)
    save("dim_user", sales.select("user_id", "user_name"))
    save("dim_rating", dim_rating(after), unique=True)
    outcomes = checked(dim_rulesets)
    of_products = [among(name, products, "product_id") for name in ("dim_product", "dim_rating")]
    save("fact_product_rating", fact_product_rating(after, *of_products), unique=True)
    known = among("dim_user", users, "user_id")
    sold = sales.select("product_id", "category").distinct()
    save("fact_sales_category", fact_sales_category(sales, sold, known), unique=True)
    save("stg_sales", after, unique=True)
    return outcomes.unionByName(checked(fact_rulesets))
