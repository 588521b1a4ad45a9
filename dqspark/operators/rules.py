"""Rules over one table, as plain data.

A rule says which columns it needs and which aggregates it reads; ``evaluate`` decides how many
passes over the table a list of rules takes. Rules come in five kinds:

* ``SchemaRule``    answered by the schema, reads no data
* ``MetricRule``    answered by aggregates of the whole table, all of them in one pass
* ``GroupRule``     answered by the row counts per key, all keys in one pass
* ``ReferenceRule`` answered by one grouping over the keys of a table and its parent
* ``SqlRule``       answered by the user's own query

Counts that break a rule never include NULLs, except in the rules about NULLs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DataType,
    IntegralType,
    NumericType,
    StringType,
    StructType,
)

from dqspark.operators.names import quoted, type_of
from dqspark.operators.thresholds import Threshold, all_hold, any_holds, thresholds
from dqspark.operators.violations import duplicated_rows, orphans

Limits = str | tuple[str, ...] | None

# Text forms of whole numbers and of numbers, and of a web address.
WHOLE_NUMBER = r"^\s*[-+]?[0-9]+\s*$"
NUMBER = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"
URI = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^\s]+$"


@dataclass(frozen=True)
class Reading:
    """What a rule saw, as expressions over the one row its pass produced.

    ``settled`` is the outcome where no data was needed to know it.
    """

    elements: Column | None = None
    unexpected: Column | None = None
    observed: Column | None = None
    passed: Column | None = None
    settled: str | None = None


@dataclass(frozen=True, kw_only=True)
class Rule:
    rule: str
    columns: tuple[str, ...] = ()
    definition: str = ""
    metrics: tuple[str, ...] = ()
    must: tuple[Threshold, ...] = ()
    warn: tuple[Threshold, ...] = ()
    fail: tuple[Threshold, ...] = ()
    patterns: tuple[str, ...] = ()

    @property
    def column(self) -> str | None:
        return ", ".join(self.columns) or None

    def outcome(self, reading: Reading) -> Column:
        """fail beats warn beats pass; the two levels are independent of each other."""
        if reading.settled:
            return F.lit(reading.settled)
        failed = [~reading.passed] if reading.passed is not None else []
        if self.fail:
            failed.append(any_holds(self.fail, reading.observed))
        if self.must:
            failed.append(~all_hold(self.must, reading.observed))
        result = F.lit("pass")
        if self.warn:
            result = F.when(any_holds(self.warn, reading.observed), "warn").otherwise(result)
        return F.when(reduce(or_, failed), "fail").otherwise(result) if failed else result

    def failing_rows(self, df: DataFrame) -> DataFrame:
        raise TypeError(f"{self.rule} is not about single rows")


# --------------------------------------------------------------------------- schema


@dataclass(frozen=True, kw_only=True)
class SchemaRule(Rule):
    """``check`` maps the schema to (holds, observed number or None)."""

    check: Callable[[StructType], tuple[bool, float | None]]


def column_exists(column: str) -> Rule:
    return SchemaRule(
        rule="column_exists",
        definition=f"column {column} exists",
        metrics=("schema",),
        columns=(column,),
        check=lambda schema: (column in schema.names, None),
    )


def required_columns(columns: Sequence[str]) -> Rule:
    """All listed columns exist, others may. Observed: how many are missing."""

    def check(schema):
        missing = set(columns) - set(schema.names)
        return not missing, float(len(missing))

    return SchemaRule(
        rule="required_columns", definition=f"columns {list(columns)} exist", metrics=("schema",), check=check
    )


def columns_ordered(columns: Sequence[str]) -> Rule:
    return SchemaRule(
        rule="columns_ordered",
        definition=f"columns are {list(columns)} in this order",
        metrics=("schema",),
        check=lambda schema: (schema.names == list(columns), None),
    )


def columns_set(columns: Sequence[str]) -> Rule:
    return SchemaRule(
        rule="columns_set",
        definition=f"columns are {sorted(columns)}",
        metrics=("schema",),
        check=lambda schema: (sorted(schema.names) == sorted(columns), None),
    )


def column_count(n: int) -> Rule:
    return SchemaRule(
        rule="column_count",
        definition=f"{n} columns",
        metrics=("schema",),
        check=lambda schema: (len(schema.names) == n, float(len(schema.names))),
    )


def of_type(column: str, type_name: str) -> Rule:
    """The declared type has this name, e.g. ``IntegerType``."""
    return SchemaRule(
        rule="of_type",
        definition=f"{column} is {type_name}",
        metrics=("schema",),
        columns=(column,),
        check=lambda schema: (type(schema[column].dataType).__name__ == type_name, None),
    )


def field_type(column: str, sql_type: str) -> Rule:
    """The declared type is this SQL type, with precision and scale, e.g. ``decimal(3,2)``."""
    return SchemaRule(
        rule="field_type",
        definition=f"{column} is {sql_type}",
        metrics=("schema",),
        columns=(column,),
        check=lambda schema: (schema[column].dataType.simpleString() == sql_type, None),
    )


# --------------------------------------------------------------------------- aggregates


class Aggregates:
    """The aggregates a pass computes; one that several rules ask for is computed once."""

    def __init__(self) -> None:
        self._aliased: list[Column] = []
        self._results: dict[str, Column] = {}

    def get(self, name: str, expression: Callable[[], Column]) -> Column:
        """The result of the aggregate of this name, which is built when first asked for."""
        if name not in self._results:
            alias = f"a{len(self._aliased)}"
            self._aliased.append(expression().alias(alias))
            self._results[name] = F.col(alias)
        return self._results[name]

    def rows(self) -> Column:
        return self.get("rows", lambda: F.count(F.lit(1)))

    def count(self, name: str, condition: Column) -> Column:
        return self.get(name, lambda: F.count_if(condition))

    def nulls(self, column: str) -> Column:
        return self.count(f"nulls of {column}", quoted(column).isNull())

    def columns(self) -> list[Column]:
        return self._aliased


def _percent(part: Column, whole: Column) -> Column:
    """Share in percent; of nothing it is zero."""
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))


@dataclass(frozen=True, kw_only=True)
class MetricRule(Rule):
    read: Callable[[Aggregates, StructType], Reading]
    bad: Callable[[DataType], Column] | None = None
    keep_value: bool = False

    def failing_rows(self, df: DataFrame) -> DataFrame:
        if self.bad is None:
            return super().failing_rows(df)
        (column,) = self.columns
        rows = df.filter(self.bad(type_of(df, column)))
        return rows.withColumn("invalid_value", quoted(column)) if self.keep_value else rows


def _row_rule(
    rule: str,
    column: str,
    bad: Callable[[DataType], Column],
    definition: str,
    mostly: float = 1.0,
    keep_value: bool = False,
) -> Rule:
    """Passes when the share of non-NULL values that are not ``bad`` is at least ``mostly``."""

    def read(aggregates: Aggregates, schema: StructType) -> Reading:
        unexpected = aggregates.count(f"{definition} broken", bad(schema[column].dataType))
        if mostly == 1.0:
            passed = unexpected == 0
        else:
            given = aggregates.rows() - aggregates.nulls(column)
            passed = (given == 0) | ((given - unexpected) / given >= mostly)
        return Reading(aggregates.rows(), unexpected, None, passed)

    return MetricRule(
        rule=rule,
        columns=(column,),
        definition=definition if mostly == 1.0 else f"{definition} in {mostly:g} of the rows",
        metrics=("unexpected_count",),
        read=read,
        bad=bad,
        keep_value=keep_value,
    )


def _table_metric(
    rule: str,
    column: str | None,
    metric: Callable[[Aggregates], Column],
    must: Limits,
    warn: Limits,
    fail: Limits,
) -> Rule:
    def read(aggregates: Aggregates, schema: StructType) -> Reading:
        return Reading(aggregates.rows(), None, metric(aggregates).cast("double"))

    return MetricRule(
        rule=rule,
        columns=(column,) if column else (),
        definition=_describe(rule, column, must, warn, fail),
        metrics=(rule,),
        must=thresholds(must),
        warn=thresholds(warn),
        fail=thresholds(fail),
        read=read,
    )


def _describe(rule: str, column: str | None, must: Limits, warn: Limits, fail: Limits) -> str:
    def text(limits: Limits, joint: str) -> str:
        return limits if isinstance(limits, str) else joint.join(limits)

    subject = f"{rule}({column})" if column else rule
    parts = [f"{subject} {text(must, ' and ')}"] if must else [subject]
    parts += [f"warn when {text(warn, ' or ')}"] if warn else []
    parts += [f"fail when {text(fail, ' or ')}"] if fail else []
    return ", ".join(parts)


def row_count(must: Limits = "> 0", warn: Limits = None, fail: Limits = None) -> Rule:
    return _table_metric("row_count", None, lambda a: a.rows(), must, warn, fail)


def _bounds(low: float | None, high: float | None) -> tuple[str, ...]:
    """Thresholds for a range that may be open on one side."""
    if low is None and high is None:
        raise ValueError("a range needs a bound")
    return tuple(f"{op} {bound}" for op, bound in ((">=", low), ("<=", high)) if bound is not None)


def row_count_between(low: int | None, high: int | None) -> Rule:
    return row_count(_bounds(low, high))


def metric_min(column: str, must: Limits = None, warn: Limits = None, fail: Limits = None) -> Rule:
    return _table_metric(
        "min", column, lambda a: a.get(f"min of {column}", lambda: F.min(quoted(column))), must, warn, fail
    )


def metric_max(column: str, must: Limits = None, warn: Limits = None, fail: Limits = None) -> Rule:
    return _table_metric(
        "max", column, lambda a: a.get(f"max of {column}", lambda: F.max(quoted(column))), must, warn, fail
    )


def not_null(column: str, mostly: float = 1.0) -> Rule:
    """``mostly`` is the share of all rows that must have a value."""

    def read(aggregates: Aggregates, schema: StructType) -> Reading:
        rows, nulls = aggregates.rows(), aggregates.nulls(column)
        return Reading(rows, nulls, None, nulls == 0 if mostly >= 1 else nulls <= F.lit(1.0 - mostly) * rows)

    return MetricRule(
        rule="not_null",
        columns=(column,),
        definition=f"{column} is not NULL",
        metrics=("missing_count",),
        read=read,
        bad=lambda dtype: quoted(column).isNull(),
    )


def missing(column: str, must: Limits = None, warn: Limits = None, fail: Limits = None) -> Rule:
    """NULLs against thresholds. A ``%`` in any of them makes the metric a share in percent."""
    limits = thresholds(must) + thresholds(warn) + thresholds(fail)
    percent = any(t.percent for t in limits)
    metric = "missing_percent" if percent else "missing_count"

    def read(aggregates: Aggregates, schema: StructType) -> Reading:
        rows, nulls = aggregates.rows(), aggregates.nulls(column)
        return Reading(rows, nulls, _percent(nulls, rows) if percent else nulls.cast("double"))

    return MetricRule(
        rule="missing",
        columns=(column,),
        definition=_describe(metric, column, must, warn, fail),
        metrics=("missing_count", "row_count") if percent else ("missing_count",),
        must=thresholds(must),
        warn=thresholds(warn),
        fail=thresholds(fail),
        read=read,
        bad=lambda dtype: quoted(column).isNull(),
    )


def _number(column: str, dtype: DataType) -> Column:
    """The value to compare with bounds; text is read as a number where it is one."""
    value = quoted(column)
    return value.try_cast("double") if isinstance(dtype, StringType) else value


def _outside(
    column: str, dtype: DataType, low, high, strict_low: bool = False, strict_high: bool = False
) -> Column:
    value = _number(column, dtype)
    broken = []
    if isinstance(dtype, StringType):
        broken.append(value.isNull())
    if low is not None:
        broken.append(value <= low if strict_low else value < low)
    if high is not None:
        broken.append(value >= high if strict_high else value > high)
    return quoted(column).isNotNull() & reduce(or_, broken) if broken else F.lit(False)


def between(
    column: str,
    low: float | None = None,
    high: float | None = None,
    strict_min: bool = False,
    strict_max: bool = False,
    mostly: float = 1.0,
) -> Rule:
    low_end, high_end = "(" if strict_min else "[", ")" if strict_max else "]"
    return _row_rule(
        "between",
        column,
        lambda dtype: _outside(column, dtype, low, high, strict_min, strict_max),
        f"{column} in {low_end}{'' if low is None else low}, {'' if high is None else high}{high_end}",
        mostly,
        keep_value=True,
    )


def non_negative(column: str) -> Rule:
    return _row_rule(
        "non_negative", column, lambda dtype: _outside(column, dtype, 0, None), f"{column} is not negative"
    )


def length_between(column: str, low: int | None = None, high: int | None = None, mostly: float = 1.0) -> Rule:
    def bad(dtype: DataType) -> Column:
        length = F.length(quoted(column))
        broken = ([length < low] if low is not None else []) + ([length > high] if high is not None else [])
        return quoted(column).isNotNull() & reduce(or_, broken) if broken else F.lit(False)

    return _row_rule(
        "length_between",
        column,
        bad,
        f"length of {column} in [{'' if low is None else low}, {'' if high is None else high}]",
        mostly,
    )


def _unmatched(column: str, regex: str) -> Column:
    return quoted(column).isNotNull() & ~quoted(column).cast("string").rlike(regex)


def matches(column: str, regex: str, mostly: float = 1.0) -> Rule:
    rule = _row_rule(
        "matches", column, lambda dtype: _unmatched(column, regex), f"{column} matches {regex}", mostly
    )
    return replace(rule, patterns=(regex,))


def uri_format(column: str) -> Rule:
    return _row_rule("uri_format", column, lambda dtype: _unmatched(column, URI), f"{column} is a URI")


def _not_of_kind(column: str, kind: str, dtype: DataType) -> Column:
    """Values whose content is not of ``kind``; only text has to be looked at."""
    if kind == "string":
        return F.lit(False)
    whole = kind in ("int", "integer")
    if isinstance(dtype, StringType):
        return _unmatched(column, WHOLE_NUMBER if whole else NUMBER)
    fits = isinstance(dtype, IntegralType) if whole else isinstance(dtype, NumericType)
    return F.lit(False) if fits else quoted(column).isNotNull()


KINDS = ("int", "integer", "float", "decimal", "string")


def data_type(column: str, kind: str) -> Rule:
    """Every value can be read as ``kind``, whatever the declared type."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    return _row_rule(
        "data_type", column, lambda dtype: _not_of_kind(column, kind, dtype), f"{column} holds {kind} values"
    )


def invalid(
    column: str,
    regex: str | None = None,
    values: Sequence | None = None,
    min: float | None = None,
    max: float | None = None,
    kind: str | None = None,
    must: Limits = None,
    warn: Limits = None,
    fail: Limits = None,
) -> Rule:
    """Share, in percent of all rows, of values breaking any of the given conditions.

    With no condition given nothing is invalid.
    """
    if kind is not None and kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")

    def bad(dtype: DataType) -> Column:
        broken = []
        if regex is not None:
            broken.append(_unmatched(column, regex))
        if values is not None:
            broken.append(quoted(column).isNotNull() & ~quoted(column).isin(list(values)))
        if min is not None or max is not None:
            broken.append(_outside(column, dtype, min, max))
        if kind is not None:
            broken.append(_not_of_kind(column, kind, dtype))
        return reduce(or_, broken) if broken else F.lit(False)

    conditions = {"regex": regex, "values": values, "min": min, "max": max, "kind": kind}
    given = ", ".join(f"{k}={v}" for k, v in conditions.items() if v is not None)
    subject = f"{column} with {given}" if given else column

    def read(aggregates: Aggregates, schema: StructType) -> Reading:
        unexpected = aggregates.count(f"invalid {subject}", bad(schema[column].dataType))
        return Reading(aggregates.rows(), unexpected, _percent(unexpected, aggregates.rows()))

    return MetricRule(
        rule="invalid",
        columns=(column,),
        definition=_describe("invalid_percent", subject, must, warn, fail),
        metrics=("invalid_count", "row_count"),
        must=thresholds(must),
        warn=thresholds(warn),
        fail=thresholds(fail),
        read=read,
        bad=bad,
    )


# --------------------------------------------------------------------------- keys


class KeyCounts:
    """Aggregates over the row counts per key, for several keys at once.

    The frame below has one row per key value with its row count ``n`` and, in ``key_set``, the
    number of the key it belongs to.
    """

    def __init__(self, aggregates: Aggregates, columns: tuple[str, ...], key_set: int) -> None:
        self._aggregates, self._columns, self._key_set = aggregates, columns, key_set

    def _total(self, name: str, amount: Column, condition: Column | None = None) -> Column:
        mine = F.col("key_set") == self._key_set
        chosen = mine if condition is None else mine & condition
        return self._aggregates.get(
            f"{name} of {self._columns}", lambda: F.coalesce(F.sum(F.when(chosen, amount)), F.lit(0))
        )

    def _present(self) -> Column:
        """Keys that are not NULL in all their columns."""
        return reduce(or_, [F.col(c).isNotNull() for c in self._columns])

    def _complete(self) -> Column:
        """Keys that are not NULL in any of their columns."""
        return ~reduce(or_, [F.col(c).isNull() for c in self._columns])

    def rows(self) -> Column:
        return self._total("rows", F.col("n"))

    def rows_of_repeated(self) -> Column:
        return self._total("repeated rows", F.col("n"), self._present() & (F.col("n") > 1))

    def repeated(self) -> Column:
        return self._total("repeated", F.lit(1), self._complete() & (F.col("n") > 1))

    def single(self) -> Column:
        return self._total("single", F.lit(1), self._complete() & (F.col("n") == 1))

    def distinct(self) -> Column:
        return self._total("distinct", F.lit(1), self._complete())


@dataclass(frozen=True, kw_only=True)
class GroupRule(Rule):
    read: Callable[[KeyCounts], Reading]

    def failing_rows(self, df: DataFrame) -> DataFrame:
        if self.rule not in ("unique", "compound_unique"):
            return super().failing_rows(df)
        return duplicated_rows(df, self.columns)


def _unique(rule: str, columns: Sequence[str], mostly: float = 1.0) -> Rule:
    def read(keys: KeyCounts) -> Reading:
        unexpected = keys.rows_of_repeated()
        held = unexpected <= F.lit(1.0 - mostly) * (unexpected + keys.single())
        return Reading(keys.rows(), unexpected, None, unexpected == 0 if mostly >= 1 else held)

    return GroupRule(
        rule=rule,
        columns=tuple(columns),
        definition=f"{', '.join(columns)} is unique",
        metrics=("duplicate_rows",),
        read=read,
    )


def unique(column: str, mostly: float = 1.0) -> Rule:
    """Every value occurs once; all rows of a value that does not are unexpected.

    ``mostly`` is the share of the non-NULL rows whose value must occur once.
    """
    return _unique("unique", [column], mostly)


def compound_unique(columns: Sequence[str]) -> Rule:
    """The same for a tuple of columns; rows NULL in all of them are left out."""
    return _unique("compound_unique", columns)


def uniqueness(column: str, must: Limits) -> Rule:
    """Values that occur exactly once, as a share of all rows."""

    def read(keys: KeyCounts) -> Reading:
        rows, single = keys.rows(), keys.single()
        return Reading(rows, rows - single, F.when(rows > 0, single / rows).otherwise(F.lit(1.0)))

    return GroupRule(
        rule="uniqueness",
        columns=(column,),
        definition=_describe("uniqueness", column, must, None, None),
        metrics=("uniqueness",),
        must=thresholds(must),
        read=read,
    )


def duplicate_count(
    columns: Sequence[str], must: Limits = None, warn: Limits = None, fail: Limits = None
) -> Rule:
    """How many values (or tuples without NULL) occur more than once."""

    def read(keys: KeyCounts) -> Reading:
        return Reading(keys.rows(), None, keys.repeated().cast("double"))

    return GroupRule(
        rule="duplicate_count",
        columns=tuple(columns),
        definition=_describe("duplicate_count", ", ".join(columns), must, warn, fail),
        metrics=("duplicate_count",),
        must=thresholds(must),
        warn=thresholds(warn),
        fail=thresholds(fail),
        read=read,
    )


def distinct_between(column: str, low: int | None, high: int | None) -> Rule:
    between = f"{low} to {high}" if None not in (low, high) else _bounds(low, high)[0]

    def read(keys: KeyCounts) -> Reading:
        return Reading(keys.rows(), None, keys.distinct().cast("double"))

    return GroupRule(
        rule="distinct_between",
        columns=(column,),
        definition=f"{between} distinct values of {column}",
        metrics=("distinct_count",),
        must=thresholds(_bounds(low, high)),
        read=read,
    )


# --------------------------------------------------------------------------- other tables, SQL


@dataclass(frozen=True, kw_only=True)
class ReferenceRule(Rule):
    parent: str
    parent_column: str

    def failing_rows_in(self, df: DataFrame, parent: DataFrame) -> DataFrame:
        return orphans(df, self.columns[0], parent, self.parent_column)


def references(column: str, parent: str, parent_column: str) -> Rule:
    """Every non-NULL value exists in ``parent``, a name among the tables given to ``evaluate``."""
    return ReferenceRule(
        rule="references",
        columns=(column,),
        definition=f"{column} exists in {parent}.{parent_column}",
        metrics=("orphan_count",),
        parent=parent,
        parent_column=parent_column,
    )


@dataclass(frozen=True, kw_only=True)
class SqlRule(Rule):
    query: str
    returns_rows: bool = False
    satisfy: tuple[str, ...] = field(default=())


def sql_metric(name: str, query: str, must: Limits = None, warn: Limits = None, fail: Limits = None) -> Rule:
    """The one number a query returns against thresholds."""
    return SqlRule(
        rule=name,
        definition=_describe("sql_metric", name, must, warn, fail),
        metrics=(name,),
        must=thresholds(must),
        warn=thresholds(warn),
        fail=thresholds(fail),
        query=query,
    )


def expr_metric(name: str, expression: str, must: Limits = None, warn: Limits = None, fail: Limits = None) -> Rule:
    """An aggregate over the table, as ``count_if(sales_amount > 100000)``, against thresholds.

    It is read in the same pass as all other metrics, where ``sql_metric`` runs a query of its own. An expression that
    the table cannot answer fails alone.
    """

    def read(aggregates: Aggregates, schema: StructType) -> Reading:
        value = aggregates.get(f"expression {expression}", lambda: F.expr(expression).cast("double"))
        return Reading(aggregates.rows(), None, value)

    return MetricRule(
        rule=name,
        definition=_describe("expr_metric", f"{name}: {expression}", must, warn, fail),
        metrics=(name,),
        must=thresholds(must),
        warn=thresholds(warn),
        fail=thresholds(fail),
        read=read,
    )


def custom_sql(query: str) -> Rule:
    """Passes when the query, which selects bad rows from ``primary``, returns none."""
    return SqlRule(
        rule="custom_sql", definition=query, metrics=("custom_sql",), query=query, returns_rows=True
    )


def contract_sql(
    query: str,
    must_be_greater_than: float | None = None,
    must_be_between: tuple[float, float] | None = None,
    must_be_equal_to: float | None = None,
    must_satisfy: Sequence[str] = (),
    must: tuple[str, ...] = (),
) -> Rule:
    """One number within bounds, or several columns that satisfy all the given conditions; without either it raises."""
    if must_be_greater_than is not None:
        must += (f"> {must_be_greater_than}",)
    if must_be_between is not None:
        must += (f">= {must_be_between[0]}", f"<= {must_be_between[1]}")
    if must_be_equal_to is not None:
        must += (f"= {must_be_equal_to}",)
    if not must and not must_satisfy:
        raise ValueError(f"no bound for {query!r}")
    return SqlRule(
        rule="contract_sql",
        definition=f"{query} must be {' and '.join(must) or ' and '.join(must_satisfy)}",
        metrics=("contract_sql",),
        must=thresholds(must),
        query=query,
        satisfy=tuple(must_satisfy),
    )
