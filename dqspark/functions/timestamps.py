"""Timestamps that result tables keep as text, and the range filter over them."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

# The two text formats of the result tables, and their date prefixes.
FORMATS = {
    "iso": "yyyy-MM-dd'T'HH:mm:ssXXX",
    "compact": "yyyyMMdd'T'HHmmss.SSSSSSX",
}
DATE_PREFIX = {"iso": "%Y-%m-%d", "compact": "%Y%m%d"}


def parse_ts(col: Column, style: str = "iso") -> Column:
    """Text -> timestamp; text in another form -> NULL."""
    return F.try_to_timestamp(col, F.lit(FORMATS[style]))


def _instant(text: str) -> datetime:
    """An ISO bound; without a zone it is meant as UTC."""
    value = datetime.fromisoformat(text)
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def time_filter(df: DataFrame, column: str, start: str, end: str, style: str = "iso") -> DataFrame:
    """Rows whose text timestamp lies in [start, end].

    The exact test parses the text, which no file format can use to skip data. Both text
    forms sort by date, so a plain comparison with the neighbouring dates goes first: it
    reaches the scan. One spare day at either end covers any zone offset in the text.
    """
    low, high = _instant(start), _instant(end)
    prefix = DATE_PREFIX[style]
    first = (low.astimezone(timezone.utc) - timedelta(days=1)).strftime(prefix)
    last = (high.astimezone(timezone.utc) + timedelta(days=2)).strftime(prefix)
    text, ts = F.col(column), parse_ts(F.col(column), style)
    return df.filter((text >= first) & (text < last)).filter(ts.between(F.lit(low), F.lit(high)))
