"""Profiles, and what is derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqspark.operators.contract import contract_from_draft, test_contract
from dqspark.operators.evaluate import evaluate
from dqspark.operators.profile import contract_from_tables, distinct_counts, profile, suite_from_profile
from dqspark.operators.profile_sketches import DEVIATION, extend_sketches, kept_sketches, profile_of
from dqspark.operators.suites import load_suite, rules_from_suite, save_suite
from dqspark.plans.columns import SALES_TYPES
from dqspark.registry import sql
from dqspark.session import scratch_path, stored
from dqspark.registry.inputs import given, raw_sales

_SHOWN = ("position", "column", "type", "count", "nulls", "distinct", "min", "max", "min_length", "max_length")


def _profile(df: DataFrame) -> DataFrame:
    return profile(df, quantiles=()).select(*_SHOWN, F.round("mean", 4).alias("mean"))


def profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(given(spark, sf_dir, "lineitem"))


def profile_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(stored(raw_sales(spark, sf_dir), "sales"))


def profile_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of lines that came in by return flag, merged from sketches: first one flag's, later the others'.

    ``distinct_near`` says whether the estimate is within three deviations of the exact count.
    """
    line, path = given(spark, sf_dir, "lineitem"), scratch_path(spark, "sketches")
    extend_sketches(line.filter("l_returnflag = 'A'"), "l_returnflag", path)
    extend_sketches(line, "l_returnflag", path)
    found = profile_of(kept_sketches(spark, path), ()).withColumnRenamed("distinct", "estimated")
    near = F.abs(F.col("estimated") - F.col("distinct")) <= 3 * DEVIATION * F.col("distinct")
    both = found.join(distinct_counts(line), "column")
    return both.select(*_SHOWN, F.round("mean", 4).alias("mean"), near.alias("distinct_near"))


_QUARTILES = (0.25, 0.5, 0.75)


def profile_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates, held against the whole table: a row for each column and quartile of numbers.

    ``rank_near`` says whether the ranks that the estimate has among the values come within 1e-4 of the quartile,
    ``distinct_near`` whether the estimated distinct count is within three deviations of the exact one.
    """
    line = given(spark, sf_dir, "lineitem")
    found = profile(line, _QUARTILES, exact_distinct=False).select("column", "quantiles", F.col("distinct").alias("estimated"))
    numbers = [c for c, t in _LINEITEM.items() if t in ("int", "bigint", "double")]
    values = line.select(*[F.col(c).cast("double") for c in numbers]).unpivot([], numbers, "column", "value")
    # Estimates are a row per column: values are counted below and up to each of them before any shuffle of values.
    ranks = values.filter("value IS NOT NULL").join(F.broadcast(found.select("column", "quantiles")), "column")
    counts = [
        F.array(*[F.count_if(F.col("value") < F.col("quantiles")[i]) for i in range(3)]).alias("below"),
        F.array(*[F.count_if(F.col("value") <= F.col("quantiles")[i]) for i in range(3)]).alias("upto"),
        F.count(F.lit(1)).alias("n"),
    ]
    ranks = ranks.groupBy("column").agg(*counts)
    both = found.join(distinct_counts(line), "column").join(ranks, "column", "left")
    quartiles = F.when(F.col("quantiles").isNotNull(), F.array(*[F.lit(q) for q in _QUARTILES]))
    rows = both.select("*", F.posexplode_outer(quartiles).alias("i", "quantile"))
    lowest, highest = (F.get(c, F.col("i")) + F.lit(sign) * (1e-4 * F.col("n") + 1) for c, sign in (("below", -1), ("upto", 1)))
    return rows.select(
        "column",
        "quantile",
        F.col("n").alias("values"),
        (F.col("quantile") * F.col("n")).between(lowest, highest).alias("rank_near"),
        "distinct",
        (F.abs(F.col("estimated") - F.col("distinct")) <= 0.15 * F.col("distinct")).alias("distinct_near"),
    )


def suite_from_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A suite derived from a profile, kept as JSON, run on the table it came from: it holds."""
    part, path = given(spark, sf_dir, "part"), scratch_path(spark, "suite")
    save_suite(spark, suite_from_profile(profile(part, quantiles=())), path)
    return evaluate(part, rules_from_suite(load_suite(spark, path))).select(
        "rule", "column", "element_count", "unexpected_count", "outcome"
    )


def contract_draft(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("part", "orders", "customer")
    return contract_from_tables({name: given(spark, sf_dir, name) for name in names})


def contract_of_draft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drafted contract, tested on the tables it came from: it holds."""
    tables = {name: given(spark, sf_dir, name) for name in ("part", "customer")}
    return test_contract(tables, contract_from_draft(contract_from_tables(tables))).select(
        "context", "rule", "column", "element_count", "unexpected_count", "outcome"
    )


QUERIES = {
    f.__name__: f
    for f in (
        profile_lineitem,
        profile_sales,
        profile_quantiles,
        profile_grown,
        suite_from_part,
        contract_draft,
        contract_of_draft,
    )
}

_LINEITEM = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
_SALES = dict.fromkeys(SALES_TYPES, "string")
_PART = {
    "p_partkey": "bigint",
    "p_name": "string",
    "p_brand": "string",
    "p_type": "string",
    "p_size": "int",
    "p_retailprice": "double",
}
_ORDERS = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}
_CUSTOMER = {
    "c_custkey": "bigint",
    "c_name": "string",
    "c_nationkey": "int",
    "c_acctbal": "double",
    "c_mktsegment": "string",
}


def _profile_sql(table: str, types: dict[str, str]) -> str:
    selects = []
    for i, (c, t) in enumerate(types.items(), 1):
        numeric, string = t in ("int", "bigint", "double"), t == "string"
        selects.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS type, count(*) AS count, "
            f"count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS \"distinct\", "
            f"CAST({f'min({c})' if numeric else 'NULL'} AS DOUBLE) AS min, "
            f"CAST({f'max({c})' if numeric else 'NULL'} AS DOUBLE) AS max, "
            f"CAST({f'min(length({c}))' if string else 'NULL'} AS BIGINT) AS min_length, "
            f"CAST({f'max(length({c}))' if string else 'NULL'} AS BIGINT) AS max_length, "
            f"round(CAST({f'avg(CAST({c} AS DOUBLE))' if numeric else 'NULL'} AS DOUBLE), 4) AS mean FROM {table}"
        )
    return "\nUNION ALL ".join(selects)


def _quantiles_sql() -> str:
    selects = []
    for c, t in _LINEITEM.items():
        numeric = t in ("int", "bigint", "double")
        for q in _QUARTILES if numeric else ("NULL",):
            selects.append(
                f"SELECT '{c}' AS \"column\", CAST({q} AS DOUBLE) AS quantile, "
                f"CAST({f'count({c})' if numeric else 'NULL'} AS BIGINT) AS \"values\", "
                f"CAST({'true' if numeric else 'NULL'} AS BOOLEAN) AS rank_near, "
                f"count(DISTINCT {c}) AS \"distinct\", true AS distinct_near FROM lineitem"
            )
    return "\nUNION ALL ".join(selects)


def _part_suite_sql() -> str:
    selects = []
    for c, t in _PART.items():
        n = "(SELECT count(*) FROM part)"
        selects += [
            f"SELECT 'column_exists' AS rule, '{c}' AS \"column\", CAST(NULL AS BIGINT) AS element_count, "
            "CAST(NULL AS BIGINT) AS unexpected_count, 'pass' AS outcome",
            f"SELECT 'not_null', '{c}', {n}, 0, 'pass' WHERE (SELECT count(*) = count({c}) FROM part)",
            f"SELECT 'unique', '{c}', {n}, 0, 'pass' WHERE (SELECT count({c}) = count(DISTINCT {c}) FROM part)",
            f"SELECT '{'length_between' if t == 'string' else 'between'}', '{c}', {n}, 0, 'pass'",
        ]
    return "\nUNION ALL ".join(selects)


def _draft_sql() -> str:
    selects = []
    for table, types in (("part", _PART), ("orders", _ORDERS), ("customer", _CUSTOMER)):
        for i, (c, t) in enumerate(types.items(), 1):
            selects.append(
                f"SELECT '{table}' AS model, CAST({i} AS INTEGER) AS position, '{c}' AS field, '{t}' AS type, "
                f"count(*) = count({c}) AS required, count({c}) = count(DISTINCT {c}) AS \"unique\" FROM {table}"
            )
    return "\nUNION ALL ".join(selects)


def _draft_outcomes_sql() -> str:
    selects = []
    for table, types in (("part", _PART), ("customer", _CUSTOMER)):
        n = f"(SELECT count(*) FROM {table})"
        for c in types:
            selects += [
                f"SELECT '{table}' AS context, 'field_type' AS rule, '{c}' AS \"column\", "
                "CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS unexpected_count, 'pass' AS outcome",
                f"SELECT '{table}', 'not_null', '{c}', {n}, 0, 'pass' "
                f"WHERE (SELECT count(*) = count({c}) FROM {table})",
                f"SELECT '{table}', 'unique', '{c}', {n}, 0, 'pass' "
                f"WHERE (SELECT count({c}) = count(DISTINCT {c}) FROM {table})",
            ]
    return "\nUNION ALL ".join(selects)


ORACLES = {
    "contract_of_draft": _draft_outcomes_sql(),
    "profile_lineitem": _profile_sql("lineitem", _LINEITEM),
    "profile_quantiles": _quantiles_sql(),
    "profile_grown": f"SELECT *, TRUE AS distinct_near FROM ({_profile_sql('lineitem', _LINEITEM)})",
    "profile_sales": sql.with_tables("raw_sales", _profile_sql("raw_sales", _SALES)),
    "suite_from_part": _part_suite_sql(),
    "contract_draft": _draft_sql(),
}
