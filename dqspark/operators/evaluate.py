"""Evaluation of rule lists.

All rules that read aggregates share one pass over the table; all rules about keys share
another, a grouping over sets of key columns. What either pass returns is one row, unfolded
into a row per rule. Everything stays a lazy DataFrame.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException, IllegalArgumentException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from dqspark.operators.names import has_columns, quoted, schema_of, type_of
from dqspark.operators.rules import (
    Aggregates,
    GroupRule,
    KeyCounts,
    MetricRule,
    Reading,
    ReferenceRule,
    Rule,
    SchemaRule,
    SqlRule,
)
from dqspark.operators.violations import as_key

RESULT_SCHEMA = (
    "position int, rule string, column string, definition string, metrics array<string>, "
    "element_count bigint, unexpected_count bigint, observed double, outcome string"
)

# A grouping id has one bit per column.
_MAX_KEY_COLUMNS = 32

_views = threading.Lock()

# A rule that cannot be answered for want of its column or table.
FAILED = Reading(settled="fail")

Answer = tuple[int, Rule, Reading]


def evaluate(
    df: DataFrame,
    rules: Sequence[Rule],
    name: str = "primary",
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per rule, with its counts and its outcome.

    ``name`` is what SQL rules call the table, besides ``primary``; ``tables`` are the others that
    SQL rules and references may name. A rule that cannot be answered fails alone: on a column the table lacks, with a
    pattern that is none, or of a bound on a column that has no order. Names follow the session's rule on case. What a
    user's SQL raises while it runs stops the whole evaluation.
    """
    numbered = list(enumerate(rules, start=1))
    answered, metric, keyed, referring, parts = [], [], [], [], []
    for position, rule in numbered:
        if not isinstance(rule, SchemaRule) and (not has_columns(df, rule.columns) or _bad_pattern(df.sparkSession, rule)):
            answered.append((position, rule, FAILED))
        elif isinstance(rule, SchemaRule):
            answered.append((position, rule, _schema_reading(rule, df)))
        elif isinstance(rule, MetricRule):
            metric.append((position, rule))
        elif isinstance(rule, GroupRule):
            keyed.append((position, rule))
        elif isinstance(rule, ReferenceRule):
            referring.append((position, rule))
    if metric or answered:
        parts.append(_metric_part(df, metric, answered))
    parts += _key_parts(df, keyed) + _reference_parts(df, referring, tables or {})
    parts += _sql_parts(df, [(p, r) for p, r in numbered if isinstance(r, SqlRule)], name, tables or {})
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def passes(rules: Sequence[Rule]) -> int:
    """How often ``evaluate`` reads the table. Above one, store a table that is costly to derive."""
    kinds = [type(rule) for rule in rules]
    shared = sum(kind in kinds for kind in (MetricRule, GroupRule))
    referring = {rule.columns for rule in rules if isinstance(rule, ReferenceRule)}
    return shared + len(referring) + kinds.count(SqlRule)


def evaluate_all(
    tables: Mapping[str, DataFrame], rulesets: Mapping[str, Sequence[Rule]], prefix: str = ""
) -> DataFrame:
    """The rules of several tables in one frame; ``context`` is the prefix and the table's name."""
    return union_results(
        [
            evaluate(tables[name], rules, name, tables).select(F.lit(prefix + name).alias("context"), "*")
            for name, rules in rulesets.items()
        ]
    )


def union_results(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def failing_rows(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows of the table that break a rule."""
    if isinstance(rule, ReferenceRule):
        return rule.failing_rows_in(df, (tables or {})[rule.parent])
    if isinstance(rule, SqlRule) and rule.returns_rows:
        with _named(df.sparkSession, {**(tables or {}), "primary": df}):
            return df.sparkSession.sql(rule.query)
    return rule.failing_rows(df)


class CheckFailed(Exception):
    """Raised on request when rules failed; carries their names."""


def validate(
    df: DataFrame,
    rules: Sequence[Rule],
    name: str = "primary",
    tables: Mapping[str, DataFrame] | None = None,
    raise_on_fail: bool = False,
) -> DataFrame:
    """``evaluate`` plus, on every row, whether its rule held and the suite's success percentage.

    A warning is no failure. With ``raise_on_fail`` the rows, one per rule, are computed here.
    """
    results = evaluate(df, rules, name, tables)
    if raise_on_fail:
        results = raise_if_failed(results)
    return with_success(results)


def with_success(results: DataFrame) -> DataFrame:
    """Add ``success`` and ``success_percent``; the latter per ``context`` where there is one.

    The window runs over rule rows, as many as there are rules, and never over table rows.
    """
    suite = Window.partitionBy("context" if "context" in results.columns else F.lit(1))
    held = F.col("outcome") != "fail"
    percent = F.lit(100.0) * F.count_if(held).over(suite) / F.count(F.lit(1)).over(suite)
    return results.withColumns({"success": held, "success_percent": percent})


def summary(results: DataFrame) -> DataFrame:
    """One row: how many rules ran, how many held, the percentage, and whether all did."""
    success = F.col("outcome") != "fail"
    return results.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(success).alias("successful"),
        F.count_if(~success).alias("unsuccessful"),
        (F.lit(100.0) * F.count_if(success) / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("success_percent"),
        F.coalesce(F.bool_and(success), F.lit(True)).alias("success"),
    )


def raise_if_failed(results: DataFrame) -> DataFrame:
    """Compute the rows, one per rule; raise if a rule failed, else return them computed."""
    rows = results.collect()
    failed = [f"{r['rule']}({r['column'] or ''})" for r in rows if r["outcome"] == "fail"]
    if failed:
        raise CheckFailed(", ".join(failed))
    return results.sparkSession.createDataFrame(rows, results.schema).coalesce(1)


# --------------------------------------------------------------------------- rows


_ABOUT = "array<struct<position:int, rule:string, column:string, definition:string, metrics:array<string>>>"


def _unfold(one_row: DataFrame, answers: Sequence[Answer]) -> DataFrame:
    """A row per rule from the one row that holds all their aggregates.

    What is known of the rules beforehand goes in as one JSON literal, what was read as one
    array per result column: a handful of expressions per rule, however long the list.
    """
    about = [
        {
            "position": position,
            "rule": rule.rule,
            "column": rule.column,
            "definition": rule.definition,
            "metrics": list(rule.metrics),
        }
        for position, rule, _ in answers
    ]
    nothing = F.lit(None)

    def gathered(name: str, sql_type: str, values: Iterable[Column | None]) -> Column:
        given = [nothing if value is None else value for value in values]
        return F.array(*given).cast(f"array<{sql_type}>").alias(name)

    readings = [reading for _, _, reading in answers]
    rows = F.arrays_zip(
        F.from_json(F.lit(json.dumps(about)), _ABOUT).alias("about"),
        gathered("element_count", "bigint", [r.elements for r in readings]),
        gathered("unexpected_count", "bigint", [r.unexpected for r in readings]),
        gathered("observed", "double", [r.observed for r in readings]),
        gathered("outcome", "string", [rule.outcome(reading) for _, rule, reading in answers]),
    )
    return one_row.select(F.inline(rows)).select(
        "about.*", "element_count", "unexpected_count", "observed", "outcome"
    )


def _schema_reading(rule: SchemaRule, df: DataFrame) -> Reading:
    lacking = rule.columns and not set(rule.columns) <= set(df.columns)
    holds, observed = (False, None) if lacking else rule.check(df.schema)
    return Reading(observed=None if observed is None else F.lit(observed), settled="pass" if holds else "fail")


# --------------------------------------------------------------------------- passes


def _metric_part(df: DataFrame, rules: list[tuple[int, MetricRule]], answered: list[Answer]) -> DataFrame:
    aggregates, schema = Aggregates(), schema_of(df)
    answers = [(position, rule, rule.read(aggregates, schema)) for position, rule in rules]
    if not answers:
        return _unfold(df.sparkSession.range(1), answered)
    try:
        return _unfold(df.agg(*aggregates.columns()), answered + answers)
    except AnalysisException:
        fit = [a for a in rules if _fits(df, a[1])]
        if len(fit) == len(rules):
            raise
        return _metric_part(df, fit, answered + [(*a, FAILED) for a in rules if a not in fit])


def _fits(df: DataFrame, rule: MetricRule) -> bool:
    """Whether the rule's aggregates can be asked of the table, by their types."""
    aggregates = Aggregates()
    rule.read(aggregates, schema_of(df))
    try:
        df.agg(*aggregates.columns() or [F.lit(1)])
    except AnalysisException:
        return False
    return True


def _bad_pattern(spark: SparkSession, rule: Rule) -> bool:
    """Whether a pattern of the rule cannot be read; Spark would find out in the tasks, and stop all rules."""
    try:
        for pattern in rule.patterns:
            spark._jvm.java.util.regex.Pattern.compile(pattern)
    except IllegalArgumentException:
        return True
    return False


def _key_parts(df: DataFrame, rules: list[tuple[int, GroupRule]]) -> list[DataFrame]:
    """Split the rules so that no grouping has too many columns, then one pass for each."""
    parts, batch, columns = [], [], set()
    for position, rule in rules:
        wider = columns | set(rule.columns)
        if batch and len(wider) > _MAX_KEY_COLUMNS:
            parts.append(_key_part(df, batch))
            batch, wider = [], set(rule.columns)
        batch.append((position, rule))
        columns = wider
    return parts + ([_key_part(df, batch)] if batch else [])


def _key_part(df: DataFrame, rules: list[tuple[int, GroupRule]]) -> DataFrame:
    counted, keys = count_per_key(df, list(dict.fromkeys(rule.columns for _, rule in rules)))
    aggregates = Aggregates()
    answers = [
        (position, rule, rule.read(KeyCounts(aggregates, *keys[rule.columns]))) for position, rule in rules
    ]
    return _unfold(counted.agg(*aggregates.columns()), answers)


def count_per_key(
    df: DataFrame, sets: Sequence[tuple[str, ...]]
) -> tuple[DataFrame, dict[tuple[str, ...], tuple[tuple[str, ...], int]]]:
    """Row count ``n`` of every key, for several sets of key columns in one grouping.

    Returns the counts and, for each set, what its columns are called there and the number that
    ``key_set`` gives it. Counts are combined on the map side, so a key that holds a third of
    the rows leaves each map task as one row.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    called = {c: f"key{i}" for i, c in enumerate(columns)}
    keys = df.select(*[quoted(c).alias(called[c]) for c in columns])
    count, names = F.count(F.lit(1)).alias("n"), {s: tuple(called[c] for c in s) for s in sets}
    if len(sets) == 1:
        counted = keys.groupBy(*keys.columns).agg(count).withColumn("key_set", F.lit(0))
        return counted, {sets[0]: (names[sets[0]], 0)}
    bit = {c: 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)}
    number = {s: sum(bit[c] for c in columns if c not in s) for s in sets}
    grouped = keys.groupingSets([[F.col(c) for c in names[s]] for s in sets], *[F.col(c) for c in keys.columns])
    counted = grouped.agg(count, F.grouping_id().alias("key_set"))
    return counted, {s: (names[s], number[s]) for s in sets}


def _reference_parts(
    df: DataFrame, rules: list[tuple[int, ReferenceRule]], tables: Mapping[str, DataFrame]
) -> list[DataFrame]:
    """One pass for each column that refers to other tables, and each type its parents' keys have."""
    parts = []
    for column in dict.fromkeys(rule.columns[0] for _, rule in rules):
        mine = [(position, rule) for position, rule in rules if rule.columns[0] == column]
        known = [a for a in mine if a[1].parent in tables and has_columns(tables[a[1].parent], [a[1].parent_column])]
        lost = [(position, rule, FAILED) for position, rule in mine if (position, rule) not in known]
        kinds = dict.fromkeys(type_of(tables[rule.parent], rule.parent_column) for _, rule in known)
        for kind in kinds:
            alike = [a for a in known if type_of(tables[a[1].parent], a[1].parent_column) == kind]
            parts.append(_reference_part(df, column, alike, tables))
        if lost:
            parts.append(_unfold(df.sparkSession.range(1), lost))
    return parts


def _reference_part(
    df: DataFrame, column: str, rules: list[tuple[int, ReferenceRule]], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Orphans by one grouping of the child's and all parents' keys together.

    No join: child counts and parent marks are combined on the map side, so neither a hot
    foreign key nor a large parent makes a large task. Text and numbers meet as ``as_key`` says; a child's text
    that is no number is an orphan.
    """
    sides = [(df, column)] + [(tables[rule.parent], rule.parent_column) for _, rule in rules]

    def keys(i: int) -> DataFrame:
        side, key = sides[i]
        value = as_key(side, key, *sides[0 if i else 1])
        unread = quoted(key).isNotNull() & value.isNull() if i == 0 else F.lit(False)
        marks = [F.lit(int(i == j)).alias(f"in{j}") for j in range(len(sides))]
        return side.select(value.alias("k"), unread.alias("unread"), *marks)

    together = reduce(DataFrame.union, [keys(i) for i in range(len(sides))])
    marks = [F.max(f"in{j}").alias(f"in{j}") for j in range(1, len(sides))]
    counted = together.groupBy("k", "unread").agg(F.sum("in0").alias("n"), *marks)

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0))

    orphaned = [
        total(F.when((F.col("unread") | F.col("k").isNotNull()) & (F.col(f"in{j}") == 0), F.col("n"))).alias(f"orphans{j}")
        for j in range(1, len(sides))
    ]
    seen = counted.agg(total(F.col("n")).alias("rows"), *orphaned)
    answers = []
    for j, (position, rule) in enumerate(rules, start=1):
        orphans = F.col(f"orphans{j}")
        answers.append((position, rule, Reading(F.col("rows"), orphans, None, orphans == 0)))
    return _unfold(seen, answers)


@contextmanager
def _named(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[None]:
    """The tables as temporary views while queries are resolved; then the session as it was.

    A resolved query keeps the tables it found, so it can run after the views are gone.
    """
    with _views:
        before = {name: _temp_view(spark, name) for name in tables}
        for name, table in tables.items():
            table.createOrReplaceTempView(name)
        try:
            yield
        finally:
            for name, view in before.items():
                if view is None:
                    spark.catalog.dropTempView(name)
                else:
                    view.createOrReplaceTempView(name)


def _temp_view(spark: SparkSession, name: str) -> DataFrame | None:
    try:
        return spark.table(name) if spark.catalog.getTable(name).isTemporary else None
    except AnalysisException:
        return None


def _resolve(spark: SparkSession, query: str) -> DataFrame | None:
    """The query's result, lazily; None if it names a column or table that is not there."""
    try:
        return spark.sql(query)
    except ParseException:
        raise
    except AnalysisException:
        return None


def _sql_parts(
    df: DataFrame, rules: list[tuple[int, SqlRule]], name: str, tables: Mapping[str, DataFrame]
) -> list[DataFrame]:
    if not rules:
        return []
    parts, spark = [], df.sparkSession
    with _named(spark, {**tables, name: df, "primary": df}):
        results = [_resolve(spark, rule.query) for _, rule in rules]
    for (position, rule), found in zip(rules, results):
        if found is None:
            parts.append(_unfold(spark.range(1), [(position, rule, FAILED)]))
            continue
        if rule.returns_rows:
            seen = found.agg(F.count(F.lit(1)).alias("n"))
            reading = Reading(None, F.col("n"), None, F.col("n") == 0)
        elif rule.satisfy:
            held = [F.coalesce(F.expr(c), F.lit(False)) for c in rule.satisfy]
            broken = reduce(Column.__add__, [F.when(h, 0).otherwise(1) for h in held])
            try:
                seen = found.select(broken.alias("n")).agg(F.sum("n").alias("n"))
            except AnalysisException:  # a condition on a column that is not there
                parts.append(_unfold(spark.range(1), [(position, rule, FAILED)]))
                continue
            reading = Reading(None, F.col("n"), None, F.coalesce(F.col("n") == 0, F.lit(False)))
        else:
            named = found.toDF("value", *[f"other{i}" for i in range(1, len(found.columns))])
            seen = named.agg(F.max("value").cast("double").alias("value"), F.count(F.lit(1)).alias("n"))
            reading = Reading(observed=F.col("value"), passed=F.col("n") <= 1)  # a metric is one number
        parts.append(_unfold(seen, [(position, rule, reading)]))
    return parts
