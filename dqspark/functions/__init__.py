"""Column functions: cleaning dirty text, percent arithmetic, timestamps kept as text."""

from dqspark.functions.clean import (
    default_text,
    is_blank,
    numeric_or_null,
    parse_count,
    parse_decimal_comma,
    parse_money,
    parse_number,
    pct,
)
from dqspark.functions.timestamps import parse_ts, time_filter

__all__ = [
    "default_text",
    "is_blank",
    "numeric_or_null",
    "parse_count",
    "parse_decimal_comma",
    "parse_money",
    "parse_number",
    "pct",
    "parse_ts",
    "time_filter",
]
