"""Profiles merged from sketches of a table's parts, against the exact values."""

import numpy as np
from pyspark.sql import functions as F

from dqspark.operators.profile import profile
from dqspark.operators.profile_sketches import DEVIATION, RANK_ERROR, extend_sketches, kept_sketches, profile_of

EXACT = ["position", "column", "type", "count", "nulls", "min", "max", "min_length", "max_length"]


def grown(spark, n):
    df = spark.range(n).select(
        (F.col("id") % 4).alias("day"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 3000).alias("a.b"),
        (F.hash("id") % 100000 / 7).alias("x"),
        F.concat(F.lit("t"), (F.col("id") % 777).cast("string")).alias("text"),
        F.lit(None).cast("double").alias("none"),
        F.timestamp_seconds(F.col("id") % 50).alias("at"),
    )
    return df.withColumn("day", F.when(F.col("day") > 0, F.col("day")))  # NULL is a part


def test_grown_profile_equals_a_fresh_one(spark, tmp_path):
    path, df = str(tmp_path / "kept"), grown(spark, 40000)
    assert kept_sketches(spark, path).isEmpty() and profile_of(kept_sketches(spark, path)).isEmpty()
    assert extend_sketches(df.filter("day <= 2"), "day", path) == 2
    # Old parts are not read again: rows that would change them do not.
    assert extend_sketches(df.unionByName(df.filter("day = 1")), "day", path) == 2
    assert extend_sketches(df, "day", path) == 0
    found, wanted = profile_of(kept_sketches(spark, path)), profile(df)
    assert set(found.columns) == set(wanted.columns)
    assert sorted(map(tuple, found.select(EXACT).collect())) == sorted(map(tuple, wanted.select(EXACT).collect()))
    exact = {r.column: r for r in wanted.collect()}
    for r in found.collect():
        assert abs(r.distinct - exact[r.column].distinct) <= 3 * DEVIATION * exact[r.column].distinct
        assert (r.mean is None) == (exact[r.column].mean is None) and (r.mean is None or abs(r.mean - exact[r.column].mean) < 1e-6)
        assert (r.quantiles is None) == (exact[r.column].quantiles is None)
        if r.quantiles is not None:
            values = np.sort([v[0] for v in df.select(F.col(f"`{r.column}`").cast("double")).collect() if v[0] is not None])
            for q, value in zip((0.25, 0.5, 0.75), r.quantiles):
                low, high = np.searchsorted(values, [value]), np.searchsorted(values, [value], "right")
                assert low[0] / len(values) - 2 * RANK_ERROR <= q <= high[0] / len(values) + 2 * RANK_ERROR
