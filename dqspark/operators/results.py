"""Rule outcomes in the shapes of the two result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dqspark.functions.clean import default_text
from dqspark.operators.evaluate import with_success

# The name a rule goes by in suites and in the suite result table.
EXPECTATIONS = {
    "column_exists": "expect_column_to_exist",
    "columns_ordered": "expect_table_columns_to_match_ordered_list",
    "columns_set": "expect_table_columns_to_match_set",
    "column_count": "expect_table_column_count_to_equal",
    "row_count": "expect_table_row_count_to_be_between",
    "not_null": "expect_column_values_to_not_be_null",
    "unique": "expect_column_values_to_be_unique",
    "compound_unique": "expect_compound_columns_to_be_unique",
    "between": "expect_column_values_to_be_between",
    "length_between": "expect_column_value_lengths_to_be_between",
    "matches": "expect_column_values_to_match_regex",
    "of_type": "expect_column_values_to_be_of_type",
    "distinct_between": "expect_column_distinct_count_to_be_between",
}


def preview(df: DataFrame, n: int = 5, *order_by: Column) -> DataFrame:
    """The first rows, in the given order if there is one."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def suite_results(results: DataFrame, run_name: str, validation_time: str, asset: str) -> DataFrame:
    """Nine typed columns, a row per rule. A rule on no single column shows ``N/A``, a rule
    without counts shows 0."""
    rows = results if "success_percent" in results.columns else with_success(results)
    names = F.create_map(*[F.lit(x) for pair in EXPECTATIONS.items() for x in pair])
    single = F.when(~F.col("column").contains(","), F.col("column"))
    return rows.select(
        F.lit(run_name).alias("run_name"),
        F.lit(validation_time).alias("validation_time"),
        F.lit(asset).alias("data_asset_name"),
        F.coalesce(names[F.col("rule")], F.col("rule")).alias("expectation_type"),
        default_text(single).alias("column"),
        "success",
        F.coalesce("element_count", F.lit(0)).cast("bigint").alias("element_count"),
        F.coalesce("unexpected_count", F.lit(0)).cast("bigint").alias("unexpected_count"),
        "success_percent",
    )


def scan_results(results: DataFrame, data_source: str, table: str, scan_time: str) -> DataFrame:
    """Ten text columns, a row per check and metric it reads."""
    metric = F.concat_ws("-", F.lit("metric"), F.lit(data_source), F.lit(table), F.col("column"), F.col("metric"))
    return results.withColumn("metric", F.explode("metrics")).select(
        F.col("definition").alias("name"),
        F.col("rule").alias("type"),
        "definition",
        F.lit(data_source).alias("dataSource"),
        F.lit(table).alias("table"),
        F.lit("").alias("filter"),
        default_text(F.col("column"), "").alias("column"),
        "outcome",
        metric.alias("metric"),
        F.lit(scan_time).alias("datetime"),
    )
