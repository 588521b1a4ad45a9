"""The plans the operators must have to work at scale."""

import pytest
from pyspark.sql import functions as F

from dqspark.operators import rules as r
from dqspark.operators.dedup import dedup
from dqspark.operators.evaluate import evaluate
from dqspark.operators.violations import duplicated_rows, orphans
from dqspark.plans import monitor as m
from dqspark.plans import warehouse as w
from dqspark.plans.rulesets import OBT_SCAN, OBT_SUITE
from dqspark.registry import suites
from dqspark.registry.inputs import given, raw_sales
from dqspark.sources.writers import upsert


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    old = {}

    def set_(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            old[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield set_
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark, sf_dir):
    text = plan(dedup(given(spark, sf_dir, "lineitem"), ["l_orderkey"], [F.desc("l_shipdate")]))
    partial = text.index("row_number(), 1, Partial")
    assert text.index("row_number(), 1, Final") < text.index("Exchange") < partial


def test_metric_rules_share_one_scan_of_their_columns(spark, sf_dir):
    rules = [r.not_null("l_tax"), r.between("l_tax", 0, 1), r.metric_max("l_tax", fail="> 1"), r.row_count()]
    text = plan(evaluate(given(spark, sf_dir, "lineitem"), rules))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<l_tax:double>" in text


def test_key_rules_share_one_scan_and_count_before_the_shuffle(spark, sf_dir):
    rules = [
        r.unique("l_orderkey"),
        r.compound_unique(["l_orderkey", "l_linenumber"]),
        r.distinct_between("l_partkey", 1, 9),
    ]
    text = plan(evaluate(given(spark, sf_dir, "lineitem"), rules))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    assert "partial_count" in text and "Join" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in text


def test_whole_suites_take_two_scans(spark, tmp_path, sf_dir):
    path = str(tmp_path / "obt")
    w.build_obt(raw_sales(spark, sf_dir)).write.parquet(path)
    for rules in (OBT_SUITE, OBT_SCAN):
        assert plan(evaluate(spark.read.parquet(path), rules)).count("FileScan") == 2


def test_references_need_no_join(spark, sf_dir):
    rule = r.references("o_custkey", "customer", "c_custkey")
    text = plan(evaluate(given(spark, sf_dir, "orders"), [rule], tables={"customer": given(spark, sf_dir, "customer")}))
    assert "Join" not in text and "partial_sum" in text


def test_no_cross_joins_and_no_python_in_any_model(spark, sf_dir):
    raw = raw_sales(spark, sf_dir)
    for df in (
        w.build_stg(raw),
        w.fact_product_rating(raw, w.dim_product(raw), w.dim_rating(raw)),
        w.fact_sales_category(raw, w.dim_product(raw), w.dim_user(raw)),
        evaluate(raw, OBT_SUITE),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text
        assert "Python" not in text and "MapInPandas" not in text


def test_facts_read_only_their_columns(spark, tmp_path, sf_dir):
    path = str(tmp_path / "stg")
    raw_sales(spark, sf_dir).write.parquet(path)
    stg = spark.read.parquet(path)
    text = plan(w.fact_sales_category(stg, w.dim_product(stg), w.dim_user(stg)))
    assert "ReadSchema: struct<product_id:string,actual_price:string,user_id:string>" in text
    assert "ReadSchema: struct<user_id:string,user_name:string>" in text


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Sales of which one product holds a third."""
    path = str(tmp_path_factory.mktemp("hot") / "sales")
    product = F.when(F.col("id") % 3 == 0, "P0").otherwise(F.concat(F.lit("P"), (F.col("id") % 5000).cast("string")))
    user = F.concat(F.lit("U"), F.col("id").cast("string"))
    price = F.lit("₹1,000.50")
    spark.range(0, 300000, numPartitions=8).select(
        product.alias("product_id"), user.alias("user_id"), price.alias("actual_price")
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def large(conf):
    """As if nothing fitted a broadcast, and partitions of some 10 KB were large."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__files__openCostInBytes="1",
        spark__sql__files__maxPartitionBytes="100KB",
    )


def test_hot_products_are_split(spark, hot, large):
    products = hot.select("product_id").distinct().withColumn("category", F.substring("product_id", 1, 2))
    users = hot.select("user_id").distinct()
    fact = w.fact_sales_category(hot, products, users)
    assert fact.agg(F.count(F.lit(1)), F.sum("sales_amount")).first()[1] == 300000 * 1000.50
    fact.collect()
    assert "skew=true" in plan(fact) and "BroadcastHashJoin" not in plan(fact)


def test_hot_names_are_split(spark, hot, large):
    """A product with very many names."""
    products = hot.select("product_id", F.col("user_id").alias("product_name"))
    ratings = hot.select("product_id", F.lit("4.5").alias("rating"))
    fact = w.fact_product_rating(hot, products, ratings)
    assert len(fact.collect()) == 300000
    assert "skew=true" in plan(fact)


def test_hot_orphans_are_split(spark, hot, large):
    parents = hot.filter("product_id <> 'P0'").select("product_id")
    found = orphans(hot, "product_id", parents, "product_id")
    assert len(found.collect()) == hot.filter("product_id = 'P0'").count()
    assert "skew=true" in plan(found) and found.columns == hot.columns


def test_hot_duplicates_are_split(spark, hot, large):
    found = duplicated_rows(hot, ["product_id"])
    assert len(found.collect()) == 300000
    assert "skew=true" in plan(found)


def test_upsert_joins_on_key_columns_and_leaves_the_target_unshuffled_for_a_small_source(spark, tmp_path, sf_dir):
    path = str(tmp_path / "orders")
    orders = given(spark, sf_dir, "orders")
    upsert(orders, path, ["o_orderkey"])
    current = spark.read.parquet(path + "/snapshot-00000001")
    keys = orders.filter("o_orderkey < 10").select("o_orderkey")
    text = plan(current.join(keys, ["o_orderkey"], "left_anti"))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_orphans_can_be_split_when_hot(spark, sf_dir, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    text = plan(orphans(given(spark, sf_dir, "orders"), "o_custkey", given(spark, sf_dir, "customer"), "c_custkey"))
    assert "LeftAnti" in text and "SortMergeJoin" in text


def test_monitoring_joins_nothing(spark):
    scans = spark.createDataFrame([], "`table` string, `column` string, metric string, outcome string, datetime string")
    text = plan(m.fail_pct_over_time(scans))
    assert "Join" not in text and text.count("hashpartitioning") <= 1


def test_facts_join_the_sales_once(spark, sf_dir):
    """Tables that read the sales several times read them written down; a dimension reads the given tables itself."""

    def reads_lines(table):
        return any("/lineitem" in f for f in table.inputFiles())

    tables = suites.warehouse_tables(spark, sf_dir)
    assert not any(reads_lines(tables[name]) for name in suites.TABLES)
    assert reads_lines(suites.warehouse_tables(spark, sf_dir, facts=False)["dim_product"])


def test_lines_meet_orders_that_have_their_customer(spark, sf_dir):
    """Of the joins of the sales one is without lines, and that with parts is the last."""
    plan = raw_sales(spark, sf_dir)._jdf.queryExecution().analyzed().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert [next(k for k in ("p_partkey", "c_custkey", "l_orderkey") if k in j) for j in joins] == [
        "p_partkey", "l_orderkey", "c_custkey",
    ]
