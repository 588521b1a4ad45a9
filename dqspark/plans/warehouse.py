"""The sales warehouse: staging, three dimensions, two facts, and the refresh that checks them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, StringType, StructType

from dqspark.functions.clean import numeric_or_null, parse_count, parse_decimal_comma, parse_money, parse_number
from dqspark.operators.dedup import dedup
from dqspark.operators.evaluate import RESULT_SCHEMA, evaluate, evaluate_all, raise_if_failed
from dqspark.operators.joins import join_reduced
from dqspark.operators.rules import Rule
from dqspark.plans.columns import DIM_PRODUCT, SALES_TYPES
from dqspark.plans.rulesets import DIM_RULESETS, FACT_RULESETS
from dqspark.session import together
from dqspark.sources.readers import read_csv
from dqspark.sources.writers import append_results, materialize, upsert

# The key of every table. A grouped fact is keyed by its whole grain.
KEYS = {
    "stg_sales": ("product_id",),
    "dim_product": ("product_id",),
    "dim_user": ("user_id",),
    "dim_rating": ("product_id", "user_id"),
    "fact_product_rating": ("product_id",),
    "fact_sales_category": ("user_id", "category"),
}

# The raw file as text; numbers are read from it in ``cast_columns``.
RAW_SCHEMA = StructType()
for _name in SALES_TYPES:
    RAW_SCHEMA.add(_name, "string")

_CLEAN: dict[str, Callable[[Column], Column]] = {
    "discounted_price": parse_number,
    "actual_price": parse_number,
    "discount_percentage": parse_number,
    "rating": lambda c: F.replace(c, F.lit(","), F.lit(".")),
    "rating_count": parse_count,
}


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StringType)


def cast_columns(
    df: DataFrame,
    types: Mapping[str, str] = SALES_TYPES,
    clean: Mapping[str, Callable[[Column], Column]] = _CLEAN,
) -> DataFrame:
    """Columns in fixed order with fixed types. Text is cleaned before it is read as a number."""

    def typed(name: str, sql_type: str) -> Column:
        value = F.col(name)
        if name in clean and _is_text(df, name):
            value = clean[name](value)
        return value.try_cast(sql_type).alias(name)

    return df.select(*[typed(name, sql_type) for name, sql_type in types.items()])


def build_stg(raw: DataFrame, order_by: Sequence[Column] = ()) -> DataFrame:
    """Staged table: typed, one row per product."""
    return dedup(cast_columns(raw), KEYS["stg_sales"], order_by)


def build_obt(raw: DataFrame, order_by: Sequence[Column] = ()) -> DataFrame:
    """One big table for checks: the same steps as staging, kept elsewhere."""
    return build_stg(raw, order_by)


def dim_product(stg: DataFrame) -> DataFrame:
    return stg.select(*DIM_PRODUCT).distinct()


def dim_user(stg: DataFrame) -> DataFrame:
    return stg.select("user_id", "user_name").distinct()


def dim_rating(stg: DataFrame, parse: bool = True) -> DataFrame:
    """A row per sale: the rating as decimal(3,2) and its count; ``parse=False`` leaves the text."""
    if not parse:
        return stg.select("user_id", "product_id", "rating", "rating_count")
    rating = (
        parse_decimal_comma(F.col("rating")) if _is_text(stg, "rating") else F.col("rating").try_cast("decimal(3,2)")
    )
    count = (
        parse_count(F.col("rating_count"))
        if _is_text(stg, "rating_count")
        else F.col("rating_count").try_cast("bigint")
    )
    return stg.select("user_id", "product_id", rating.alias("rating"), count.alias("rating_count"))


def _average(df: DataFrame, column: str) -> Column:
    """Mean as a double. Decimals are summed exactly, so the order of the rows cannot show."""
    if isinstance(df.schema[column].dataType, DecimalType):
        total = F.sum(F.col(column).cast("decimal(38,2)"))
        return total.cast("double") / F.nullif(F.count(column), F.lit(0))
    return F.avg(numeric_or_null(F.col(column)))


def fact_product_rating(stg: DataFrame, products: DataFrame, ratings: DataFrame) -> DataFrame:
    """Average rating per product that was sold and rated.

    Joining the three tables on the product and averaging would repeat every rating once per
    sale, the square of a hot product's rows, without changing the average. Here ratings shrink
    to one row per product and sales to the set of product ids; these two meet where they were
    grouped, and only then are the names of the products joined.
    """
    average = ratings.groupBy("product_id").agg(_average(ratings, "rating").alias("avg_rating"))
    sold = stg.select("product_id").distinct()
    rated = average.join(sold, "product_id", "left_semi").withColumnRenamed("product_id", "rated_id")
    names = products.select("product_id", "product_name").distinct()
    return join_reduced(names, rated, "product_id", "rated_id").select(
        "product_id", "product_name", "avg_rating"
    )


def fact_sales_category(stg: DataFrame, products: DataFrame, users: DataFrame) -> DataFrame:
    """Sales per user and category, exact decimals.

    A product or user may have several rows in its dimension and then counts that often; the
    dimensions enter as key and number of rows, so joins never multiply sales. Sales are summed
    per user and category before users are joined. The one join of all sales is with products,
    where AQE can split a hot product.
    """
    price = F.col("actual_price")
    price = parse_money(price) if _is_text(stg, "actual_price") else price.try_cast("decimal(10,2)")
    sales = stg.select("product_id", "user_id", price.alias("price"))
    categories = products.groupBy(F.col("product_id").alias("sold_id"), "category").agg(
        F.count(F.lit(1)).alias("product_rows")
    )
    known = users.groupBy(F.col("user_id").alias("known_id")).agg(F.count(F.lit(1)).alias("user_rows"))
    summed = (
        join_reduced(sales, categories, "product_id", "sold_id")
        .groupBy("user_id", "category")
        .agg(F.sum((F.col("price") * F.col("product_rows")).cast("decimal(20,2)")).alias("amount"))
    )
    amount = (F.col("amount") * F.col("user_rows")).cast("decimal(20,2)")
    return join_reduced(summed, known, "user_id", "known_id").select(
        "user_id", "category", amount.alias("sales_amount")
    )


def build(
    model: DataFrame,
    name: str,
    rules: Sequence[Rule],
    tables: Mapping[str, DataFrame] | None = None,
    on_fail: str = "continue",
) -> DataFrame:
    """Write a model as a table, then test the table. ``on_fail="raise"`` stops at a failure."""
    table = materialize(model, name)
    results = evaluate(table, rules, name, tables)
    return raise_if_failed(results) if on_fail == "raise" else results


def now() -> str:
    """The time of a run, in the form that result tables hold."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S+00:00")


def keep_outcomes(results: DataFrame, out: str, run_name: str, at: str) -> None:
    stamped = results.withColumns({"run_name": F.lit(run_name), "datetime": F.lit(at)})
    append_results(stamped, f"{out}/dq_results", "context")


def refresh(
    spark: SparkSession,
    raw: DataFrame | str,
    out: str,
    order_by: Sequence[Column] = (),
    dim_rulesets: Mapping[str, Sequence[Rule]] = DIM_RULESETS,
    fact_rulesets: Mapping[str, Sequence[Rule]] = FACT_RULESETS,
    raise_on_fail: bool = False,
    run_name: str = "refresh",
    multi_line: bool = False,
) -> DataFrame:
    """Staging, dimensions, their checks, facts, their checks. Returns the outcomes of this run.

    Every table is upserted below ``out`` and read back before it is used, so each later step
    scans a table and repeats no earlier work, also after the loss of executors. Outcomes are
    appended to ``out/dq_results`` with the run's name and time, a partition per context. With ``raise_on_fail``
    facts are not built on dimensions that failed. ``multi_line`` reads a CSV whose texts have line breaks.
    """
    rows = read_csv(spark, raw, RAW_SCHEMA, multi_line) if isinstance(raw, str) else raw
    at = now()

    def save(name: str, df: DataFrame) -> DataFrame:
        order, grouped = order_by if name == "stg_sales" else (), name.startswith("fact_")
        return upsert(df, f"{out}/{name}", KEYS[name], order, unique=grouped)

    def check(tables: Mapping[str, DataFrame], rulesets: Mapping[str, Sequence[Rule]]) -> DataFrame:
        outcomes = evaluate_all(tables, rulesets).collect()  # one row per rule
        results = spark.createDataFrame(outcomes, f"context string, {RESULT_SCHEMA}").coalesce(1)
        keep_outcomes(results, out, run_name, at)
        return raise_if_failed(results) if raise_on_fail else results

    stg = save("stg_sales", cast_columns(rows))
    tables = together(
        {
            "dim_product": lambda: save("dim_product", stg.select(*DIM_PRODUCT)),
            "dim_user": lambda: save("dim_user", stg.select("user_id", "user_name")),
            "dim_rating": lambda: save("dim_rating", dim_rating(stg)),
        }
    )
    dim_outcomes = check(tables, dim_rulesets)
    products, users, ratings = tables["dim_product"], tables["dim_user"], tables["dim_rating"]
    tables |= together(
        {
            "fact_product_rating": lambda: save(
                "fact_product_rating", fact_product_rating(stg, products, ratings)
            ),
            "fact_sales_category": lambda: save("fact_sales_category", fact_sales_category(stg, products, users)),
        }
    )
    return dim_outcomes.unionByName(check(tables, fact_rulesets))


def refresh_obt(
    spark: SparkSession,
    raw: DataFrame | str,
    out: str,
    rules: Sequence[Rule],
    name: str = "obt_sales",
    order_by: Sequence[Column] = (),
    run_name: str = "refresh_obt",
    multi_line: bool = False,
) -> DataFrame:
    """One big table, upserted at ``out/name``, then its checks; outcomes are also kept, as ``refresh`` does."""
    rows = read_csv(spark, raw, RAW_SCHEMA, multi_line) if isinstance(raw, str) else raw
    table = upsert(cast_columns(rows), f"{out}/{name}", KEYS["stg_sales"], order_by)
    outcomes = evaluate(table, rules, name).collect()  # one row per rule
    results = spark.createDataFrame(outcomes, RESULT_SCHEMA).coalesce(1)
    keep_outcomes(results.withColumn("context", F.lit(name)), out, run_name, now())
    return results
