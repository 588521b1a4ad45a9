from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dqspark.functions import (
    default_text,
    is_blank,
    numeric_or_null,
    parse_count,
    parse_decimal_comma,
    parse_money,
    parse_number,
    parse_ts,
    pct,
    time_filter,
)


def on(spark, function, *values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", function(F.col("v")).alias("r"))
    return [row["r"] for row in sorted(df.collect())]


def test_decimal_comma(spark):
    found = on(spark, parse_decimal_comma, "4,2", "4.25", " 3 ", "|", "", None, "12,5")
    assert found == [Decimal("4.20"), Decimal("4.25"), Decimal("3.00"), None, None, None, None]


def test_count_drops_thousands_commas(spark):
    assert on(spark, parse_count, "24,269", "7", "1,234,567", "x", "", None) == [24269, 7, 1234567, None, None, None]
    assert on(spark, parse_count, "4.0", "1,000.", "4.5", "-2.00") == [4, 1000, None, -2]


def test_money(spark):
    found = on(spark, parse_money, "₹1,099.50", "12", "", "free", None, "1.2.3", "₹123,456,789.00")
    assert found == [Decimal("1099.50"), Decimal("12.00"), None, None, None, None, None]


def test_number(spark):
    assert on(spark, parse_number, "64%", "₹2,500", "%", None) == [64.0, 2500.0, None, None]
    assert on(spark, parse_number, "-12.5", "1.5E3", "-5%", "-₹1,234.50", " 7 ") == [-12.5, 1500.0, -5.0, -1234.5, 7.0]
    assert on(spark, parse_number, "NaN", "1d", "inf", "1-2", "E3", "") == [None] * 6


def test_numeric_or_null_wants_the_whole_text(spark):
    assert on(spark, numeric_or_null, "4.2", "4,2", "|", "", "1.2.3", None) == [4.2, None, None, None, None, None]


def test_blank(spark):
    assert on(spark, is_blank, "  ", "", "a ", None) == [True, True, False, None]


def test_default_text(spark):
    assert on(spark, default_text, "a", None) == ["a", "N/A"]


@pytest.mark.parametrize("part, whole, digits, wanted", [(1, 3, 2, 33.33), (1, 3, None, 100.0 / 3), (0, 0, 2, None)])
def test_pct(spark, part, whole, digits, wanted):
    assert spark.range(1).select(pct(F.lit(part), F.lit(whole), digits).alias("p")).first()["p"] == wanted


def test_timestamps(spark):
    text = [("2024-01-23T05:06:07+00:00", "20240123T050607.000000Z"), ("2024-01-23T07:06:07+02:00", "x"), ("?", None)]
    df = spark.createDataFrame(text, "iso string, compact string").select(
        F.unix_timestamp(parse_ts(F.col("iso"), "iso")).alias("a"),
        F.unix_timestamp(parse_ts(F.col("compact"), "compact")).alias("b"),
    )
    assert [tuple(r) for r in df.collect()] == [(1705986367, 1705986367), (1705986367, None), (None, None)]


def test_time_filter_bounds_and_zones(spark):
    times = [
        "2024-01-22T23:59:59+00:00",
        "2024-01-23T00:00:00+00:00",
        "2024-01-22T14:00:00-10:00",
        "2024-01-24T10:00:00+10:00",
        "2024-01-24T00:00:01+00:00",
        "no time",
        None,
    ]
    df = spark.createDataFrame([(t,) for t in times], "t string")
    kept = time_filter(df, "t", "2024-01-23T00:00:00", "2024-01-24T00:00:00+00:00")
    assert sorted(r["t"] for r in kept.collect()) == sorted(times[1:4])


def test_time_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("2024-01-22T23:59:59+00:00",)], "t string").write.parquet(str(tmp_path / "t"))
    df = time_filter(spark.read.parquet(str(tmp_path / "t")), "t", "2024-01-23T00:00:00", "2024-01-24T00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,2024-01-22)" in plan and "LessThan(t,2024-01-26)" in plan
