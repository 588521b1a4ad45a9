"""Column profiles of a table, and rules that hold for what a profile saw."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from dqspark.operators.results import EXPECTATIONS


def _named(name: str) -> Column:
    """A column by its plain name, whatever dots or backticks that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def profile(
    df: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), exact_distinct: bool | Sequence[str] = True
) -> DataFrame:
    """One row per column: count, nulls, range, mean, lengths, quantiles, distinct values.

    Everything but exact distinct counts comes from one aggregation. Exact counts need the values of a column
    shuffled once; ``exact_distinct`` names the columns that have them, all by default, and the others get
    HyperLogLog estimates (relative deviation 0.05) from the first pass. Quantiles are always estimates (relative
    rank error 1e-4). The input is read twice if any count is exact: store one that is costly to derive.
    """
    exact = [f.name for f in df.schema.fields if exact_distinct is True or exact_distinct and f.name in exact_distinct]
    aggregates, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(df.schema.fields):
        c, numeric, text = _named(f.name), isinstance(f.dataType, NumericType), isinstance(f.dataType, StringType)
        value = c.cast("double")
        seen = {
            "count": F.count(c),
            "min": F.min(c).cast("double") if numeric else None,
            "max": F.max(c).cast("double") if numeric else None,
            "mean": F.avg(value) if numeric else None,
            "min_length": F.min(F.length(c)).cast("bigint") if text else None,
            "max_length": F.max(F.length(c)).cast("bigint") if text else None,
            "quantiles": F.percentile_approx(value, list(quantiles), 10000) if numeric and quantiles else None,
            "distinct": None if f.name in exact else F.approx_count_distinct(c),
        }
        aggregates += [e.alias(f"{k}_{i}") for k, e in seen.items() if e is not None]

        def got(k, sql_type):
            return (F.lit(None) if seen[k] is None else F.col(f"{k}_{i}")).cast(sql_type).alias(k)

        fields = [
            F.lit(i + 1).cast("int").alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("rows").alias("count"),
            (F.col("rows") - F.col(f"count_{i}")).alias("nulls"),
            *[got(k, "double") for k in ("min", "max", "mean")],
            *[got(k, "bigint") for k in ("min_length", "max_length")],
            got("quantiles", "array<double>"),
        ]
        rows.append(F.struct(*fields, got("distinct", "bigint")))
    columns = df.agg(*aggregates).select(F.inline(F.array(*rows)))
    if not exact:
        return columns
    counted = distinct_counts(df, exact).withColumnRenamed("distinct", "counted")
    joined = columns.join(counted, "column", "left")
    return joined.withColumn("distinct", F.coalesce("distinct", "counted")).drop("counted")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact number of distinct non-NULL values of the columns, all by default, as ``column`` and ``distinct``.

    Each column is a grouping of its own, so no row carries more than one value: a scan reads that column alone,
    all scans together read the table once, and values are combined on the map side before the shuffle.
    """
    parts = [
        df.agg(F.count_distinct(_named(c)).alias("distinct")).select(F.lit(c).alias("column"), "distinct")
        for c in (df.columns if columns is None else columns)
    ]
    return reduce(DataFrame.unionByName, parts)


def suite_from_profile(profiled: DataFrame) -> dict:
    """A suite, in its dictionary form, that the profiled table fulfils.

    Only the profile, a row per column, comes to the driver.
    """
    expectations = []

    def expect(rule: str, **kwargs) -> None:
        expectations.append({"expectation_type": EXPECTATIONS[rule], "kwargs": kwargs})

    for row in sorted(profiled.collect(), key=lambda row: row["position"]):
        column, given = row["column"], row["count"] - row["nulls"]
        expect("column_exists", column=column)
        if row["count"] and not row["nulls"]:
            expect("not_null", column=column)
        if given and row["distinct"] == given:
            expect("unique", column=column)
        if row["min"] is not None:
            expect("between", column=column, min_value=row["min"], max_value=row["max"])
        if row["min_length"] is not None:
            expect("length_between", column=column, min_value=row["min_length"], max_value=row["max_length"])
    return {"expectations": expectations}


def contract_from_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Draft of a contract: model, field, type, and the constraints the data fulfils today."""
    parts = None
    for model, df in tables.items():
        seen = profile(df, quantiles=()).select(
            F.lit(model).alias("model"),
            "position",
            F.col("column").alias("field"),
            "type",
            ((F.col("count") > 0) & (F.col("nulls") == 0)).alias("required"),
            ((F.col("count") > F.col("nulls")) & (F.col("distinct") == F.col("count") - F.col("nulls"))).alias(
                "unique"
            ),
        )
        parts = seen if parts is None else parts.unionByName(seen)
    return parts
