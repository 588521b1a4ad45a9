"""Rule lists from dictionaries, which are kept as JSON files."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from dqspark.operators import rules as r
from dqspark.operators.results import EXPECTATIONS

_RULE_OF = {expectation: rule for rule, expectation in EXPECTATIONS.items()}


def save_suite(spark: SparkSession, suite: Mapping[str, Any], path: str) -> None:
    """Keep a suite as JSON, on whatever file system the path names."""
    spark.createDataFrame([(json.dumps(suite),)], "value string").write.mode("overwrite").text(path)


def load_suite(spark: SparkSession, path: str) -> dict[str, Any]:
    """A suite from a JSON file or from where ``save_suite`` put it."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def rules_from_suite(suite: Mapping[str, Any]) -> list[r.Rule]:
    """``{"expectations": [{"expectation_type": ..., "kwargs": {...}}, ...]}`` -> rules."""
    return [rule_from_expectation(e["expectation_type"], e.get("kwargs", {})) for e in suite["expectations"]]


def rule_from_expectation(expectation: str, kwargs: Mapping[str, Any]) -> r.Rule:
    name, k = _RULE_OF[expectation], dict(kwargs)
    column, mostly = k.get("column"), k.get("mostly", 1.0)
    low, high = k.get("min_value"), k.get("max_value")
    if name == "column_exists":
        return r.column_exists(column)
    if name in ("not_null", "unique"):
        return getattr(r, name)(column, mostly)
    if name in ("columns_ordered", "columns_set"):
        return getattr(r, name)(k.get("column_list") or k["column_set"])
    if name == "column_count":
        return r.column_count(k["value"])
    if name == "compound_unique":
        return r.compound_unique(k["column_list"])
    if name == "of_type":
        return r.of_type(column, k["type_"])
    if name == "matches":
        return r.matches(column, k["regex"], mostly)
    if name == "length_between":
        return r.length_between(column, low, high, mostly)
    if name == "between":
        return r.between(column, low, high, k.get("strict_min", False), k.get("strict_max", False), mostly)
    if name == "distinct_between":
        return r.distinct_between(column, low, high)
    return r.row_count_between(low, high)
