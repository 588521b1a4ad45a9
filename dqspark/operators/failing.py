"""All failing rows of a suite at once, each with the rules it breaks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dqspark.operators.joins import same_keys
from dqspark.operators.names import has_columns, quoted, type_of, unlike
from dqspark.operators.rules import GroupRule, MetricRule, ReferenceRule, Rule
from dqspark.operators.violations import orphans, repeated_keys

#: Rules about a key that single rows can break.
_UNIQUE = ("unique", "compound_unique")


def tags_rows(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame]) -> bool:
    """Whether the rule can be broken by single rows of the table, and has the columns and table it needs."""
    if not has_columns(df, rule.columns):
        return False
    if isinstance(rule, ReferenceRule):
        return rule.parent in tables and has_columns(tables[rule.parent], [rule.parent_column])
    return rule.rule in _UNIQUE if isinstance(rule, GroupRule) else isinstance(rule, MetricRule) and rule.bad is not None


def tagged_rows(
    df: DataFrame, rules: Sequence[Rule], tables: Mapping[str, DataFrame] | None = None, column: str = "broken"
) -> DataFrame:
    """The rows that break any rule of a suite, once each, with the positions (from 1) of the rules they break.

    Rules on values are flags of one scan. For a rule on a key or a reference the keys that break it are found first,
    from its columns alone, and the rows are joined with those few. Rules that no single row breaks (counts, minima,
    shares, a user's SQL), and those on missing columns or tables, tag nothing; ``mostly`` and levels do not matter here.
    Rows equal in all columns stay as often as they are there. ``column`` must be none of the table's.
    """
    if has_columns(df, [column]):
        raise ValueError(f"the table has a column {column}")
    others = tables or {}
    flags: list[Column] = []
    rows = df
    for position, rule in enumerate(rules, start=1):
        if not tags_rows(df, rule, others):
            continue
        if isinstance(rule, MetricRule):
            broken = rule.bad(type_of(df, rule.columns[0]))
        else:
            mark = unlike([*rows.columns, column], f"_breaks{position}")
            rows = _marked(rows, df, rule, others, mark)
            broken = F.col(mark).isNotNull()
        flags.append(F.when(broken, F.lit(position)))
    tagged = rows.withColumn(column, F.array_compact(F.array(*flags).cast("array<int>")))
    return tagged.filter(F.size(column) > 0).select(*[quoted(c) for c in df.columns], column)


def _marked(rows: DataFrame, df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame], mark: str) -> DataFrame:
    """Rows with ``mark`` set where their key is among those that break the rule."""
    if isinstance(rule, ReferenceRule):
        key = rule.columns[0]
        lost = orphans(df.select(quoted(key)).distinct(), key, tables[rule.parent], rule.parent_column)
        return _joined(rows, lost, [key], mark)
    return _joined(rows, repeated_keys(df, rule.columns), rule.columns, mark)


def _joined(rows: DataFrame, keys: DataFrame, names: Sequence[str], mark: str) -> DataFrame:
    """A left join on null-safe keys, which Spark shuffles for, so that it can split a hot key."""
    few, same, renamed = same_keys(rows, keys.withColumn(mark, F.lit(True)), list(names))
    return rows.join(few, same, "left").drop(*renamed)


def rows_breaking(tagged: DataFrame, position: int, column: str = "broken") -> DataFrame:
    """Of tagged rows those that break the rule at a position, without the tags."""
    return tagged.filter(F.array_contains(column, position)).drop(column)
