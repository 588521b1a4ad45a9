"""Models against their plain definitions, and the refresh end to end."""

import random
import re
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dqspark.operators.evaluate import CheckFailed, evaluate, evaluate_all
from dqspark.operators.rules import not_null, row_count
from dqspark.plans import warehouse as w
from dqspark.plans.rulesets import DIM_RULESETS, FACT_RULESETS
from dqspark.registry import tables
from dqspark.sources.readers import load_tables, read_csv
from dqspark.sources.snapshots import read_snapshot
from dqspark.sources.writers import append_results, write_csv

RAW = list(w.SALES_TYPES)


def raw_row(**values):
    return tuple(values.get(c) for c in RAW)


@pytest.fixture(scope="module")
def sales(spark):
    """A hot product, products with two descriptions, users with two names, NULL keys, dirty numbers."""
    rng, rows = random.Random(3), []
    for i in range(600):
        product = rng.choice(["P0", "P0", f"P{rng.randrange(12)}", None])
        user = rng.choice([f"U{rng.randrange(9)}", None])
        rows.append(
            raw_row(
                product_id=product,
                product_name=rng.choice([f"name {product}", None]),
                category=rng.choice(["A", "B", None]),
                actual_price=rng.choice(["₹1,099.50", "₹7", "free", "", None, f"{i}.25"]),
                rating=rng.choice(["4,2", "3.5", "|", None, "1"]),
                rating_count=rng.choice(["1,234", "x", None]),
                user_id=user,
                user_name=rng.choice(["x", "y", None]),
                review_id=f"R{i}",
            )
        )
    return spark.createDataFrame(rows, w.RAW_SCHEMA).repartition(5)


def as_set(df):
    return sorted(map(str, df.collect()))


def by_key(df, key, value):
    """The rows of a frame as lists of values per key, without NULL keys."""
    found = defaultdict(list)
    for row in df.collect():
        if row[key] is not None:
            found[row[key]].append(value(row))
    return found


def price(text):
    digits = re.sub("[^0-9.]", "", text or "")
    return Decimal(digits).quantize(Decimal("0.01")) if digits else None


def test_fact_sales_category_counts_every_match(sales):
    """Each sale counts once for every row that its product and its user have in their dimensions."""
    products, users = w.dim_product(sales), w.dim_user(sales)
    categories, often = by_key(products, "product_id", lambda r: r["category"]), by_key(users, "user_id", lambda r: 1)
    wanted = defaultdict(list)
    for product, sold in by_key(sales, "product_id", lambda r: (r["user_id"], price(r["actual_price"]))).items():
        for user, amount in sold:
            for category in categories[product]:
                wanted[user, category] += [amount] * len(often[user]) if user is not None else []
    total = {k: sum((a for a in v if a is not None), Decimal(0)) if any(a is not None for a in v) else None for k, v in wanted.items() if v}
    fact = w.fact_sales_category(sales, products, users)
    assert fact.schema["sales_amount"].dataType.simpleString() == "decimal(20,2)"
    assert {(r["user_id"], r["category"]): r["sales_amount"] for r in fact.collect()} == total


@pytest.mark.parametrize("parse", [True, False])
def test_fact_product_rating_is_the_mean_of_ratings(sales, parse):
    products, ratings = w.dim_product(sales), w.dim_rating(sales, parse)

    def number(row):
        text = str(row["rating"])
        return float(text) if re.fullmatch("[0-9.]+", text) else None

    wanted = set()
    names, sold = by_key(products, "product_id", lambda r: r["product_name"]), by_key(sales, "product_id", lambda r: 1)
    for product, given in by_key(ratings, "product_id", number).items():
        known = [n for n in given if n is not None]
        mean = round(sum(known) / len(known), 9) if known else None
        wanted |= {(product, name, mean) for name in names[product] if sold[product]}
    fact = w.fact_product_rating(sales, products, ratings)
    assert {tuple(r) for r in fact.withColumn("avg_rating", F.round("avg_rating", 9)).collect()} == wanted


def test_staging_has_fixed_types_and_one_row_per_product(sales):
    stg = w.build_stg(sales, [F.desc("review_id")])
    assert dict(stg.dtypes) == w.SALES_TYPES and stg.columns == RAW
    assert stg.count() == stg.select("product_id").distinct().count()


def test_staging_survivor_does_not_depend_on_layout(sales):
    first = as_set(w.build_stg(sales.repartition(1)))
    assert first == as_set(w.build_stg(sales.repartition(7, "review_id")))


def test_models_also_take_staged_numbers(sales):
    stg = w.cast_columns(sales)
    ratings = w.dim_rating(stg)
    assert dict(ratings.dtypes)["rating"] == "decimal(3,2)" and dict(ratings.dtypes)["rating_count"] == "bigint"
    assert as_set(ratings) == as_set(w.dim_rating(sales))
    fact = w.fact_sales_category(stg, w.dim_product(stg), w.dim_user(stg))
    assert fact.filter("sales_amount IS NOT NULL").count() > 0


def test_refresh_twice_changes_nothing(spark, sales, tmp_path):
    out = str(tmp_path / "wh")
    first = w.refresh(spark, sales, out, [F.desc("review_id")])
    before = {name: as_set(read_snapshot(spark, f"{out}/{name}")) for name in w.KEYS}
    second = w.refresh(spark, sales, out, [F.desc("review_id")])
    assert as_set(first) == as_set(second)
    for name, keys in w.KEYS.items():
        table = read_snapshot(spark, f"{out}/{name}")
        assert as_set(table) == before[name]
        assert table.count() == table.select(*keys).distinct().count()
    tables = load_tables(spark, out, w.KEYS, "snapshot")
    rulesets = DIM_RULESETS | FACT_RULESETS
    assert as_set(evaluate_all(tables, rulesets).drop("metrics")) == as_set(second.drop("metrics"))
    stored = spark.read.parquet(f"{out}/dq_results")
    assert stored.count() == 2 * first.count()
    assert {r["context"] for r in stored.select("context").distinct().collect()} == {
        "dim_product",
        "dim_user",
        "dim_rating",
        "fact_product_rating",
        "fact_sales_category",
    }


def test_refresh_from_csv_and_stop_at_failure(spark, sales, tmp_path):
    write_csv(sales.filter("product_id IS NOT NULL"), str(tmp_path / "csv"))
    out = str(tmp_path / "wh")
    with pytest.raises(CheckFailed, match="not_null"):
        w.refresh(spark, str(tmp_path / "csv"), out, raise_on_fail=True)
    assert read_snapshot(spark, f"{out}/dim_user").count() > 0
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, f"{out}/fact_sales_category")


def test_build_tests_the_written_table(spark, sales):
    results = w.build(w.dim_user(sales), "built_dim_user", [not_null("user_id"), row_count()])
    assert spark.catalog.tableExists("built_dim_user")
    assert {r["rule"]: r["outcome"] for r in results.collect()} == {"not_null": "fail", "row_count": "pass"}
    with pytest.raises(CheckFailed):
        w.build(w.dim_user(sales), "built_dim_user", [not_null("user_id")], on_fail="raise")


def test_obt_then_checks(spark, sales, tmp_path):
    results = w.refresh_obt(spark, sales, str(tmp_path), [row_count(), not_null("product_id")])
    assert {r["rule"]: r["outcome"] for r in results.collect()} == {"row_count": "pass", "not_null": "fail"}
    kept = spark.read.parquet(f"{tmp_path}/dq_results").collect()
    assert {(r["context"], r["run_name"], r["rule"], r["outcome"]) for r in kept} == {
        ("obt_sales", "refresh_obt", "row_count", "pass"), ("obt_sales", "refresh_obt", "not_null", "fail")
    }
    assert all(re.fullmatch(r"[0-9-]{10}T[0-9:]{8}\+00:00", r["datetime"]) for r in kept)


def test_csv_goes_by_its_header(spark, sales, tmp_path):
    turned, broken = str(tmp_path / "turned"), str(tmp_path / "broken")
    write_csv(sales.select(*reversed(RAW)), turned)
    with pytest.raises(Exception, match="(?i)header"):
        w.refresh_obt(spark, turned, str(tmp_path / "a"), [row_count()])
    lines = sales.filter("product_id = 'P1'").limit(1).withColumn("review_content", F.lit("one\ntwo"))
    write_csv(lines, broken)
    w.refresh_obt(spark, broken, str(tmp_path / "b"), [row_count()], multi_line=True)
    assert [r["review_content"] for r in read_snapshot(spark, str(tmp_path / "b/obt_sales")).collect()] == ["one\ntwo"]


def test_csv_of_sales_takes_little_disk(spark, tmp_path, monkeypatch):
    """The CSV that is staged is compressed, has all sales, and reads back as it was: quotes, commas, spaces, NULLs, repeats."""
    base, i = str(tmp_path), F.col("id")
    odd = F.element_at(F.array(*[F.lit(v) for v in ('a "b", c', " two  ", "₹é", "\\", None, "x\ty")]), (i % 6 + 1).cast("int"))
    made = {
        "lineitem": [(i % 500).alias("l_orderkey"), F.when(i % 50 != 0, i % 40).alias("l_partkey"), (i % 7 + 1).alias("l_linenumber"),
                     (i % 50).cast("double").alias("l_quantity"), (i * 1.01).cast("double").alias("l_extendedprice"),
                     F.lit(0.05).alias("l_discount"), F.lit("A").alias("l_returnflag"), odd.alias("l_linestatus")],
        "orders": [F.when(i % 3000 < 490, i % 490).alias("o_orderkey"), (i % 20).alias("o_custkey"),
                   odd.alias("o_orderpriority"), odd.alias("o_orderstatus")],
        "part": [(i % 39).alias("p_partkey"), odd.alias("p_name"), odd.alias("p_type"), odd.alias("p_brand"), i.alias("p_size")],
        "customer": [i.alias("c_custkey"), odd.alias("c_name")],
    }
    for (name, columns), n in zip(made.items(), (3000, 600, 45, 20)):
        spark.range(n).select(*columns).write.parquet(f"{base}/{name}.parquet")
    monkeypatch.setattr(tables, "scratch_path", lambda spark, label: f"{base}/kept")
    staged, raw = tables.csv_stage(spark, base), tables.raw_sales(spark, base)
    write_csv(raw, f"{base}/plain")

    def disk(folder):
        return sum(f.stat().st_size for f in (tmp_path / folder).glob("part-*"))

    assert all(f.name.endswith(".csv.gz") for f in (tmp_path / "kept").glob("part-*")) and 0 < disk("kept") < disk("plain") / 2
    assert raw.count() > 2000
    for found, wanted in ((read_csv(spark, f"{base}/kept"), raw), (staged, w.cast_columns(raw))):
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_results_can_be_appended(spark, sales, tmp_path):
    results = evaluate(sales, [row_count()])
    append_results(results, str(tmp_path / "r"))
    append_results(results, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 2


def test_many_sales_meet_their_parts_in_a_shuffle(spark, sf_dir, monkeypatch):
    """After it each product leaves one task as one row, not every task; parts are hashed, and the rows are the same."""
    from dqspark.registry import inputs

    few = inputs.raw_sales(spark, sf_dir)
    monkeypatch.setattr(inputs, "MANY_LINES", 100)
    many = inputs.raw_sales(spark, sf_dir)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [l_partkey" in plan and "hashpartitioning(l_partkey" in plan
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()


def test_what_is_paid_is_counted_in_whole_cents_where_it_can_be(spark):
    from dqspark.registry import inputs

    prices = [0.0, -0.0, 0.01, 0.05, 1.15, 8.25, 1234.5, 99999.99, 1e6, 0.005, 1.005, -0.01, -7.5, 1e6 + 0.01, 1e9, None]
    shares = [0.0, -0.0, 0.02, 0.07, 0.1, 0.5, 1.0, 0.005, 1.01, -0.01, None]
    rows = spark.createDataFrame([(p, d) for p in prices for d in shares], "price double, discount double")
    price, discount = F.col("price"), F.col("discount")
    fast, exact = inputs._paid_cents(price, discount), inputs._paid(price, discount)
    seen = rows.select("price", "discount", fast.alias("fast"), exact.alias("exact")).collect()
    for r in seen:
        usual = r.price in prices[:9] and r.discount in shares[:7]
        assert (r.fast is not None) == usual, r
        assert r.fast is None or r.fast == r.exact, r


def test_an_increment_makes_the_texts_of_its_own_orders(spark, sf_dir, monkeypatch):
    """The priorities are filtered where orders are read, not after all texts are made; together the increments are all sales."""
    from dqspark.registry import inputs, tables

    seen = []
    monkeypatch.setattr(tables, "refresh_changes", lambda spark, increment, *args, **options: seen.append(increment))
    monkeypatch.setattr(tables, "read_table", lambda *args: None)
    tables.refreshed_changes(spark, sf_dir)
    first, others = seen
    for increment in seen:
        plan = increment._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Filter \(+(NOT )?coalesce\(o_orderpriority", plan)
    raw, both = inputs.raw_sales(spark, sf_dir), first.unionAll(others)
    assert both.exceptAll(raw).isEmpty() and raw.exceptAll(both).isEmpty()
