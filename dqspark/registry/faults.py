"""Faulty rows, rules, files and keys: each is told apart, and the rest goes on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dqspark.functions.clean import numeric_or_null
from dqspark.operators.evaluate import evaluate
from dqspark.operators.failing import tagged_rows
from dqspark.operators.rules import (
    between,
    compound_unique,
    expr_metric,
    matches,
    metric_max,
    not_null,
    references,
    row_count,
)
from dqspark.operators.violations import orphans
from dqspark.registry.inputs import given, scan_rows
from dqspark.session import scratch_path
from dqspark.sources.readers import read_csv_checked, register_results
from dqspark.sources.writers import append_results


def failing_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines that break a suite's rules on values, keys and references, once each, with the rules they break."""
    rules = [
        between("l_discount", 0.02, 0.08),
        matches("l_returnflag", "^[AN]$"),
        compound_unique(["l_orderkey", "l_linenumber"]),
        references("l_partkey", "part", "p_partkey"),
        not_null("l_tax"),
        row_count("> 0"),
    ]
    parts = given(spark, sf_dir, "part").filter("p_size > 5")
    tagged = tagged_rows(given(spark, sf_dir, "lineitem"), rules, {"part": parts})
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return tagged.select(*columns, F.array_join("broken", ",").alias("broken"))


def orphans_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose day, a text that is not always one, is no day on which lines were shipped."""
    day = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderpriority") == "1-URGENT", "x").otherwise(""))
    child = given(spark, sf_dir, "orders").select("o_orderkey", day.alias("order_day"))
    shipped = given(spark, sf_dir, "lineitem").filter("l_quantity > 48").select(F.to_date("l_shipdate").alias("day"))
    return orphans(child, "order_day", shipped, "day")


def numeric_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers go through the numeric guard as they are, text only if it is digits and dots."""
    customer = given(spark, sf_dir, "customer")
    text = F.concat(F.col("c_custkey").cast("string"), F.when(F.col("c_mktsegment") == "BUILDING", "E2").otherwise(".5"))
    return customer.select(
        "c_custkey",
        numeric_or_null(F.col("c_acctbal") * 100000).alias("from_number"),
        numeric_or_null(F.col("c_custkey")).alias("from_count"),
        numeric_or_null(text).alias("from_text"),
    )


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV of orders in which urgent ones have a field too many and high ones a key that is no number."""
    orders, path = given(spark, sf_dir, "orders"), scratch_path(spark, "dirty-csv")
    priority = F.col("o_orderpriority")
    key = F.concat(F.when(priority == "2-HIGH", "q").otherwise(""), F.col("o_orderkey").cast("string"))
    customer = F.concat(F.col("o_custkey").cast("string"), F.when(priority == "1-URGENT", ",EXTRA").otherwise(""))
    # Written as one column, so that commas stay what they are; its name is the header of the two that are read.
    dirty = orders.select(F.concat_ws(",", key, customer).alias("o_orderkey,o_custkey"))
    dirty.write.options(header=True, sep=";").csv(path)
    good, bad = read_csv_checked(spark, path, "o_orderkey long, o_custkey long")
    kept = good.select(F.lit("good").alias("kind"), F.concat_ws(",", "o_orderkey", "o_custkey").alias("line"))
    return kept.unionByName(bad.select(F.lit("quarantine").alias("kind"), "line"))


def results_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result table that gained a column with its second append."""
    rows, path = scan_rows(spark, sf_dir), scratch_path(spark, "results")
    prefix = "dq_" + path.rsplit("-", 1)[-1] + "_"
    append_results(rows.filter("outcome = 'fail'"), f"{path}/scan")
    register_results(spark, path, prefix)
    owned = rows.filter("outcome <> 'fail'").withColumn("owner", F.concat(F.lit("team "), F.col("table")))
    append_results(owned, f"{path}/scan")
    (name,) = register_results(spark, path, prefix)
    return spark.table(name).groupBy("outcome", "owner").agg(F.count(F.lit(1)).alias("n"))


def rules_alone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on a dotted column and on one written in other case are answered; bad rules fail alone."""
    table = given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Id"),
        F.col("c_acctbal").alias("acct.bal"),
        F.array("c_name").alias("names"),
        "c_name",
    )
    rules = [
        not_null("id"),
        between("acct.bal", 0, 1e9),
        between("names", 1, 2),
        matches("c_name", "("),
        metric_max("acct.bal", must="> 0"),
        not_null("no_such"),
        expr_metric("broken", "count_if(no_such > 1)", must="> 0"),
    ]
    return evaluate(table, rules).select("position", "rule", "unexpected_count", "outcome")


def rule_expr_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts under a condition and other aggregates, as rules that share one pass."""
    rules = [
        expr_metric("large", "count_if(o_totalprice > 100000)", must="> 0"),
        expr_metric("share", "count_if(o_orderstatus = 'F') * 100 / count(*)", warn="> 10", fail="> 99"),
        expr_metric("spread", "max(o_totalprice) - min(o_totalprice)", must="< 0"),
    ]
    return evaluate(given(spark, sf_dir, "orders"), rules).select("position", "rule", "element_count", "observed", "outcome")


QUERIES = {
    f.__name__: f
    for f in (
        failing_tagged,
        orphans_dates,
        numeric_values,
        csv_quarantine,
        results_grown,
        rules_alone,
        rule_expr_metric,
    )
}

ORACLES = {
    "failing_tagged": """WITH lines AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS times FROM lineitem),
tagged AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, concat_ws(',',
 CASE WHEN l_discount < CAST(0.02 AS DOUBLE) OR l_discount > CAST(0.08 AS DOUBLE) THEN '1' END,
 CASE WHEN l_returnflag NOT IN ('A', 'N') THEN '2' END, CASE WHEN times > 1 THEN '3' END,
 CASE WHEN l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) THEN '4' END,
 CASE WHEN l_tax IS NULL THEN '5' END) AS broken FROM lines)
SELECT * FROM tagged WHERE broken <> ''""",
    "orphans_dates": """WITH child AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d')
 || CASE WHEN o_orderpriority = '1-URGENT' THEN 'x' ELSE '' END AS order_day FROM orders)
SELECT * FROM child WHERE order_day NOT IN
 (SELECT strftime(l_shipdate, '%Y-%m-%d') FROM lineitem WHERE l_quantity > 48)""",
    "numeric_values": """SELECT c_custkey, c_acctbal * 100000 AS from_number, CAST(c_custkey AS DOUBLE) AS from_count,
 CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey + CAST(0.5 AS DOUBLE) END AS from_text FROM customer""",
    "csv_quarantine": """SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'quarantine' ELSE 'good' END AS kind,
 CASE WHEN o_orderpriority = '2-HIGH' THEN 'q' ELSE '' END || o_orderkey || ',' || o_custkey
 || CASE WHEN o_orderpriority = '1-URGENT' THEN ',EXTRA' ELSE '' END AS line FROM orders""",
    "results_grown": """SELECT CASE event_type WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'warn' ELSE 'pass' END AS outcome,
 CASE WHEN event_type <> 'error' THEN 'team t' || CAST(user_id % 5 AS VARCHAR) END AS owner, count(*) AS n
FROM events GROUP BY 1, 2""",
    "rules_alone": """SELECT 1 AS position, 'not_null' AS rule, count(*) - count(c_custkey) AS unexpected_count,
 CASE WHEN count(*) = count(c_custkey) THEN 'pass' ELSE 'fail' END AS outcome FROM customer
UNION ALL SELECT 2, 'between', count(*) FILTER (c_acctbal < 0 OR c_acctbal > 1e9),
 CASE WHEN bool_or(c_acctbal < 0 OR c_acctbal > 1e9) THEN 'fail' ELSE 'pass' END FROM customer
UNION ALL SELECT 3, 'between', NULL, 'fail' UNION ALL SELECT 4, 'matches', NULL, 'fail'
UNION ALL SELECT 5, 'max', NULL, CASE WHEN max(c_acctbal) > 0 THEN 'pass' ELSE 'fail' END FROM customer
UNION ALL SELECT 6, 'not_null', NULL, 'fail' UNION ALL SELECT 7, 'broken', NULL, 'fail'""",
    "rule_expr_metric": """WITH seen AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice > 100000) AS large,
 CAST(count(*) FILTER (o_orderstatus = 'F') * 100 AS DOUBLE) / count(*) AS share,
 max(o_totalprice) - min(o_totalprice) AS spread FROM orders)
SELECT 1 AS position, 'large' AS rule, n AS element_count, CAST(large AS DOUBLE) AS observed,
 CASE WHEN large > 0 THEN 'pass' ELSE 'fail' END AS outcome FROM seen
UNION ALL SELECT 2, 'share', n, share, CASE WHEN share > 99 THEN 'fail' WHEN share > 10 THEN 'warn' ELSE 'pass' END FROM seen
UNION ALL SELECT 3, 'spread', n, spread, CASE WHEN spread < 0 THEN 'pass' ELSE 'fail' END FROM seen""",
}
