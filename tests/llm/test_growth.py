"""Ranges and blocks that grow with the input keep the laws of sharding and mixing."""

from pyspark.sql import functions as F

from dqspark.llm import mixing, sharding


def _docs(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(20000).select(
        F.col("id").alias("doc_id"),
        F.when(hot, "the hot text").otherwise(F.repeat(F.concat(F.lit("w"), (F.col("id") / 6).cast("int"), F.lit(" ")), 5)).alias("text"),
        F.when(hot, "a").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
    )


def test_more_ranges(spark):
    """Ranges of 300 bytes: shards stay even, slots gapless, and only the hot text is divided."""
    found = sharding.shard(_docs(spark), shards=4, range_bytes=300).toPandas()
    sizes = found.groupby("shard")["size"].sum()
    assert len(sizes) == 4 and sizes.max() < 1.03 * sizes.mean() and sizes.min() > 0.97 * sizes.mean()
    for _, own in found.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    assert found[found.doc_id % 3 != 0].groupby("text_crc32")["shard"].nunique().max() == 1


def test_ranges_follow_the_bytes(spark, monkeypatch):
    asked = []
    kept = sharding._splitters
    monkeypatch.setattr(sharding, "_splitters", lambda keyed, total, ranges, *rest: asked.append((total, ranges)) or kept(keyed, total, ranges, *rest))
    docs = _docs(spark)
    sharding.shard(docs, shards=4)
    sharding.shard(docs, shards=4, range_bytes=1000)
    (total, few), (_, many) = asked
    assert few == 4 * sharding.RANGES and many == 4 * -(-total // 4000) > few


def test_more_blocks(spark, monkeypatch):
    assert [mixing.block_limit(n) for n in (0, 1024 * 4096, 1024 * 4096 + 1, 10**10)] == [1024, 1024, 2048, 1 << 22]
    monkeypatch.setattr(mixing, "FULL", 2)
    assert mixing.block_limit(20000) == 16384
    planned = mixing.plan(_docs(spark))
    sums = planned.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    assert all(abs(r.taken - r.target) <= 5 for r in sums.collect())
    assert planned.agg(F.max("copies")).first()[0] <= 2
