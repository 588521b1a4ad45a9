"""Every pipeline stage on awkward tables, and hot keys that Spark must be able to split."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from dqspark.llm import urls
from dqspark.llm.common import meeting
from dqspark.llm.components import components
from dqspark.operators.joins import join_reduced

#: Names that operators add or use.
TAKEN = (
    "size source_size target copies shards shard slot score predicted fingerprint component_id root fp id hash text_crc32 "
    "_leak_id _leak_hash c0 c1 rank key range a.b"
).split()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """As if nothing fitted a broadcast, and partitions of some 10 KB were large."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.files.maxPartitionBytes": "100KB",
    }
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_keeps_columns_of_any_name(spark, sf_dir, given, name, stage):
    """What a stage adds for itself is not taken for the input's, which come out as they went in."""
    clashing = given.withColumns({n: F.concat(F.lit("mine "), F.col("doc_id").cast("string")) for n in TAKEN})
    wanted = stage(spark, given, sf_dir).select("doc_id", "text")
    done = stage(spark, clashing, sf_dir)
    found = done.collect()
    assert sorted((r.doc_id, r.text or "") for r in found) == sorted((r.doc_id, r.text or "") for r in wanted.collect())
    replaced = ["size", "text_crc32", "shard", "slot"] if name == "shards" else []
    if not replaced:
        assert done.columns == clashing.columns
    assert all(r[n] == f"mine {r.doc_id}" for r in found for n in TAKEN if n not in replaced)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_of_nothing_and_of_nulls(spark, sf_dir, given, name, stage):
    assert stage(spark, given.limit(0), sf_dir).count() == 0
    nulls = spark.createDataFrame([(None,) * len(given.columns)] * 3, given.schema)
    found = stage(spark, nulls, sf_dir)
    assert set(given.columns) <= set(found.columns)
    # Empty texts: copies of which one stays; rows without words go along in the mix; shards hold all.
    wanted = {"near duplicates": [1], "decontamination": [3], "mixture": [3], "shards": [3], "quality": [0, 3]}
    assert found.count() in wanted[name]


def test_survivor_of_equal_ids_and_texts(spark, sf_dir):
    rows = [(1, "one and the same text", "en", s, 5) for s in ("d", "a", None, "c")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, schema).repartition(4)
        assert [r.source for r in corpus_pipeline.unlike(spark, docs, sf_dir).collect()] == ["a"]


def test_hot_urls_are_split(spark, tmp_path, large):
    url = F.when(F.col("id") % 3 == 0, "http://a.net/").otherwise(F.concat(F.lit("http://h"), F.col("id") % 5000, F.lit(".org/")))
    spark.range(0, 300000, numPartitions=8).select(F.col("id").alias("page_id"), url.alias("url")).write.parquet(f"{tmp_path}/p")
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    judged = urls.judge(spark.read.parquet(f"{tmp_path}/p"), rules)
    assert sum(r.verdict == "block" for r in judged.collect()) == 100000
    assert "skew=true" in plan(judged)


def test_hot_keys_that_meet_are_split(spark, tmp_path, large):
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1)
    spark.range(0, 300000, numPartitions=8).select(key.alias("key"), F.col("id")).write.parquet(f"{tmp_path}/k")
    met = meeting(spark.read.parquet(f"{tmp_path}/k"), "key", F.col("id"), 50000, ["id"])
    assert sum(r.low == r.high for r in met.collect()) == 300000
    assert "skew=true" in plan(met)


def test_hot_nodes_are_split(spark, tmp_path, large):
    """The star join of one round; a star of many nodes comes out as one component."""
    edges = spark.range(1, 200001, numPartitions=8).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    edges.write.parquet(f"{tmp_path}/e")
    edges = spark.read.parquet(f"{tmp_path}/e")
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    lowest = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("low"))
    joined = join_reduced(both, lowest, "a", "of")
    assert len(joined.collect()) == 400000 and "skew=true" in plan(joined)
    assert components(edges).filter("root != 0").count() == 0
