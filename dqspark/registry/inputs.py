"""The sales input and result tables the queries run on, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, n: int):
    return F.col(column) % n == 0


def _grouped(value, digits: int):
    return F.format_number(value, digits)


def _paid(price, discount):
    """The price less the discount, both as decimals, rounded to cents."""
    left = F.lit(1) - discount.cast("decimal(4,2)")
    return F.round(price.cast("decimal(12,2)") * left, 2).cast("double")


def _paid_cents(price, discount):
    """``_paid`` of doubles next to whole cents, up to a million, and whole percent; else NULL. Whole numbers take less time."""
    cents, percent = F.floor(price * 100 + 0.5), F.floor(discount * 100 + 0.5)
    usual = cents.between(0, 100_000_000) & percent.between(0, 100) & (cents / 100 == price) & (percent / 100 == discount)
    return F.when(usual, F.floor((cents * (100 - percent) + 50) / 100) / 100)


#: From so many lines on, sales meet their parts in a shuffle, also where parts would fit a broadcast.
MANY_LINES = 8_000_000


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sales file as it comes in: 16 text columns with currency signs, thousands commas, decimal
    commas, negative prices, exponents, counts with a decimal part, junk, NULLs, blanks, bad links, users with and
    without a name, and repeated review ids, one row per order line.

    Orders meet their customers before there is a row per line, so lines are shuffled for two joins, not three. Parts come
    last: where Spark shuffles for them a product's rows are in one task, and leave it as one in what is kept per product.

    Of many lines, those of a part do so even if parts fit a broadcast: after a broadcast every task would hold, and send
    on, a row of nearly every product. Parts, the smaller side, are hashed, so lines need no sort; AQE splits a hot part.

    What is paid is mostly computed below that join: the JVM compiles no method of more than 8000 bytes of code, and with the typed
    columns behind them the texts come close to that.
    """
    line, order = given(spark, sf_dir, "lineitem"), given(spark, sf_dir, "orders")
    part, customer = given(spark, sf_dir, "part"), given(spark, sf_dir, "customer")
    bought = order.join(customer, F.col("c_custkey") == F.col("o_custkey"))
    if line.count() >= MANY_LINES:
        part = part.hint("shuffle_hash")
    lines = line.join(bought, F.col("o_orderkey") == F.col("l_orderkey")).withColumn(
        "paid", _paid_cents(F.col("l_extendedprice"), F.col("l_discount"))
    )
    sales = lines.join(part, F.col("p_partkey") == F.col("l_partkey"))
    paid = F.coalesce("paid", _paid(F.col("l_extendedprice"), F.col("l_discount")))
    refund = _every("l_orderkey", 83)
    stars = (F.col("l_quantity") / 10).cast("decimal(3,1)").cast("string")
    part_text = F.col("l_partkey").cast("string")
    columns = {
        "product_id": F.concat(F.lit("P"), part_text),
        "product_name": F.when(_every("l_partkey", 53), "   ").otherwise(F.col("p_name")),
        "category": F.when(~_every("l_partkey", 41), F.col("p_type")),
        "discounted_price": F.when(_every("l_orderkey", 103), F.concat((F.col("l_quantity") / 4).cast("string"), F.lit("E2")))
        .when(refund | ~_every("l_orderkey", 89), F.concat(F.when(refund, "-₹").otherwise("₹"), _grouped(paid, 2))),
        "actual_price": F.concat(F.when(refund, "-₹").otherwise("₹"), _grouped(F.col("l_extendedprice"), 2)),
        "discount_percentage": F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")),
        "rating": F.when(_every("l_orderkey", 97), "|")
        .when(_every("l_orderkey", 5), F.replace(stars, F.lit("."), F.lit(",")))
        .otherwise(stars),
        "rating_count": F.when(
            ~_every("l_orderkey", 101),
            F.concat(
                _grouped(F.col("l_partkey") * F.col("l_linenumber"), 0),
                F.when(_every("l_orderkey", 107), ".0").otherwise(""),
            ),
        ),
        "about_product": F.concat_ws(
            " ", "p_brand", "p_name", F.lit("size"), F.col("p_size").cast("string")
        ),
        "user_id": F.concat(F.lit("U"), F.col("o_custkey").cast("string")),
        "user_name": F.when(~(_every("o_custkey", 67) & (F.col("l_linenumber") % 2 == 1)), F.col("c_name")),
        "review_id": F.concat_ws(
            "-", F.concat(F.lit("R"), F.col("l_orderkey").cast("string")), F.col("l_linenumber").cast("string")
        ),
        "review_title": F.col("o_orderpriority"),
        "review_content": F.when(
            F.col("l_linenumber") != 7,
            F.concat("l_returnflag", "l_linestatus", F.lit(" "), "o_orderstatus"),
        ),
        "img_link": F.concat(
            F.lit("https://img.example.com/"),
            part_text,
            F.when(_every("l_partkey", 10), ".bmp").otherwise(".jpg"),
        ),
        "product_link": F.concat(
            F.when(_every("l_partkey", 20), "ftp://").otherwise("https://"),
            F.lit("www.example.com/p/"),
            part_text,
        ),
    }
    return sales.select(*[value.alias(name) for name, value in columns.items()])


def _outcome():
    return (
        F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "signup", "warn").otherwise("pass")
    )


def _table():
    return F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string"))


def _column():
    return F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string"))


def scan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of a scan result table: runs at full hours, one row per event."""
    return given(spark, sf_dir, "events").select(
        _table().alias("table"),
        _column().alias("column"),
        F.col("event_type").alias("metric"),
        _outcome().alias("outcome"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("datetime"),
    )


def suite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of a suite result table."""
    return given(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd'T'HHmmss.SSSSSS'Z'").alias("validation_time"),
        _table().alias("data_asset_name"),
        F.col("event_type").alias("expectation_type"),
        _column().alias("column"),
        (_outcome() == "pass").alias("success"),
        (F.col("value") % 100).alias("success_percent"),
    )
