"""Profiles that grow with a table: sketches per part of it, kept as rows, merged when a profile is asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import FractionalType, IntegerType, LongType, NumericType, StringType

from dqspark.operators.names import has_columns, quoted

#: Log2 of a distinct sketch's registers (deviation 1.04 / sqrt(2^12) = 0.016) and size of a rank sketch (error 0.005).
REGISTERS, RANKS = 12, 800
DEVIATION, RANK_ERROR = 0.01625, 0.005

_SEEN = "count bigint, nulls bigint, min double, max double, total double, min_length bigint, max_length bigint"
SKETCHES = f"part string, position int, column string, type string, {_SEEN}, distinct_sketch binary, rank_sketch binary"


def _hashed(df: DataFrame, name: str) -> Column:
    """A column in a form that the distinct sketch takes; numbers without fraction, text and bytes as they are."""
    kind, value = df.schema[name].dataType, quoted(name)
    if isinstance(kind, (IntegerType, LongType, StringType)):
        return value
    return (value + F.lit(0.0) if isinstance(kind, FractionalType) else value).cast("string")  # -0.0 is 0.0


def sketches(df: DataFrame, part: Column) -> DataFrame:
    """One row per part and column: counts, range, sum, lengths, and sketches of distinct values and of ranks.

    One aggregation over one scan; a part's row is combined on the map side, a few KB a column.
    """
    aggregates, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(df.schema.fields):
        c, numeric, text = quoted(f.name), isinstance(f.dataType, NumericType), isinstance(f.dataType, StringType)
        value = c.cast("double")
        seen = {
            "count": F.count(c),
            "min": F.min(value) if numeric else None,
            "max": F.max(value) if numeric else None,
            "total": F.sum(value) if numeric else None,
            "min_length": F.min(F.length(c)) if text else None,
            "max_length": F.max(F.length(c)) if text else None,
            "distinct_sketch": F.hll_sketch_agg(_hashed(df, f.name), REGISTERS),
            "rank_sketch": F.kll_sketch_agg_double(value, RANKS) if numeric else None,
        }
        aggregates += [e.alias(f"{k}_{i}") for k, e in seen.items() if e is not None]

        def got(k: str, sql_type: str) -> Column:
            return (F.lit(None) if seen[k] is None else F.col(f"{k}_{i}")).cast(sql_type).alias(k)

        rows.append(
            F.struct(
                F.lit(i + 1).cast("int").alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("rows").alias("count"),
                (F.col("rows") - F.col(f"count_{i}")).alias("nulls"),
                *[got(k, "double") for k in ("min", "max", "total")],
                *[got(k, "bigint") for k in ("min_length", "max_length")],
                *[got(k, "binary") for k in ("distinct_sketch", "rank_sketch")],
            )
        )
    grouped = df.groupBy(part.cast("string").alias("_part")).agg(*aggregates)
    return grouped.select(F.col("_part").alias("part"), F.inline(F.array(*rows)))


def kept_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The sketches kept at a path; none where nothing was written yet."""
    try:
        return spark.read.schema(SKETCHES).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], SKETCHES)


def extend_sketches(df: DataFrame, by: str, path: str) -> int:
    """Sketch the parts of a table that the path does not have yet, and return how many those were.

    ``by`` says a row's part: a partition column or the number of a run, so that old parts are not read; a part must not
    change once it is sketched. NULL is a part. The parts' names, not their rows, come to the driver.
    """
    if not has_columns(df, [by]):
        raise ValueError(f"the table has no column {by}")
    spark = df.sparkSession
    known = [r.part for r in kept_sketches(spark, path).select("part").distinct().collect()]
    name = quoted(by).cast("string")
    seen = name.isin([k for k in known if k is not None]) | (F.lit(None in known) & name.isNull())
    new = sketches(df.filter(~F.coalesce(seen, F.lit(False))), quoted(by))
    before = len(known)
    new.write.mode("append").parquet(path)
    return kept_sketches(spark, path).select("part").distinct().count() - before


def profile_of(kept: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile of all parts together, in the columns of ``profile``; no table is read.

    Counts, range, mean and lengths are exact; ``distinct`` has a relative deviation of ``DEVIATION``, quantiles a rank
    error of ``RANK_ERROR`` (with 99 % confidence). A column that some parts lack counts in those that have it.
    """
    ranks = F.filter(F.collect_list("rank_sketch"), lambda s: s.isNotNull())
    merged = kept.groupBy("column", "type").agg(
        F.min("position").alias("position"),
        *[F.sum(c).alias(c) for c in ("count", "nulls", "total")],
        *[F.min(c).alias(c) for c in ("min", "min_length")],
        *[F.max(c).alias(c) for c in ("max", "max_length")],
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct"),
        ranks.alias("ranks"),
    )
    given = F.col("count") - F.col("nulls")
    first = F.get("ranks", F.lit(0))
    sketch = F.aggregate(F.slice("ranks", 2, F.greatest(F.size("ranks"), F.lit(1))), first, lambda a, b: F.kll_sketch_merge_double(a, b))
    found = [F.kll_sketch_get_quantile_double(sketch, F.lit(float(q))) for q in quantiles]
    held = F.when((given > 0) & (F.size("ranks") > 0), F.array(*found)) if found else F.lit(None)
    return merged.select(
        "position",
        "column",
        "type",
        "count",
        "nulls",
        "min",
        "max",
        (F.col("total") / F.nullif(given, F.lit(0))).alias("mean"),
        "min_length",
        "max_length",
        held.cast("array<double>").alias("quantiles"),
        "distinct",
    )
