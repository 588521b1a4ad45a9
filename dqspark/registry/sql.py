"""SQL texts the oracles share: the derived tables, and one SELECT per rule."""

from __future__ import annotations

RAW_SALES = """raw_sales AS (
SELECT 'P' || CAST(l_partkey AS VARCHAR) AS product_id,
 CASE WHEN l_partkey % 53 = 0 THEN '   ' ELSE p_name END AS product_name,
 CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE p_type END AS category,
 CASE WHEN l_orderkey % 103 = 0 THEN CAST(l_quantity / 4 AS VARCHAR) || 'E2' WHEN l_orderkey % 89 = 0 AND l_orderkey % 83 <> 0 THEN NULL ELSE CASE WHEN l_orderkey % 83 = 0 THEN '-₹' ELSE '₹' END || format('{:,.2f}', CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE)) END AS discounted_price,
 CASE WHEN l_orderkey % 83 = 0 THEN '-₹' ELSE '₹' END || format('{:,.2f}', l_extendedprice) AS actual_price,
 CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS discount_percentage,
 CASE WHEN l_orderkey % 97 = 0 THEN '|'
      WHEN l_orderkey % 5 = 0 THEN replace(CAST(CAST(l_quantity / 10 AS DECIMAL(3,1)) AS VARCHAR), '.', ',')
      ELSE CAST(CAST(l_quantity / 10 AS DECIMAL(3,1)) AS VARCHAR) END AS rating,
 CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE format('{:,}', l_partkey * l_linenumber) || CASE WHEN l_orderkey % 107 = 0 THEN '.0' ELSE '' END END AS rating_count,
 p_brand || ' ' || p_name || ' size ' || CAST(p_size AS VARCHAR) AS about_product,
 'U' || CAST(o_custkey AS VARCHAR) AS user_id,
 CASE WHEN o_custkey % 67 = 0 AND l_linenumber % 2 = 1 THEN NULL ELSE c_name END AS user_name,
 'R' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS review_id,
 o_orderpriority AS review_title,
 CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag || l_linestatus || ' ' || o_orderstatus END AS review_content,
 'https://img.example.com/' || CAST(l_partkey AS VARCHAR) || CASE WHEN l_partkey % 10 = 0 THEN '.bmp' ELSE '.jpg' END AS img_link,
 CASE WHEN l_partkey % 20 = 0 THEN 'ftp://' ELSE 'https://' END || 'www.example.com/p/' || CAST(l_partkey AS VARCHAR) AS product_link
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey JOIN customer ON c_custkey = o_custkey
)"""

TYPED_COLUMNS = """product_id, product_name, category,
 TRY_CAST(replace(replace(discounted_price, '₹', ''), ',', '') AS DOUBLE) AS discounted_price,
 TRY_CAST(replace(replace(actual_price, '₹', ''), ',', '') AS DOUBLE) AS actual_price,
 TRY_CAST(rtrim(discount_percentage, '%') AS DOUBLE) AS discount_percentage,
 TRY_CAST(replace(rating, ',', '.') AS DOUBLE) AS rating,
 TRY_CAST(split_part(replace(rating_count, ',', ''), '.', 1) AS INTEGER) AS rating_count,
 about_product, user_id, user_name, review_id, review_title, review_content, img_link, product_link"""

STG_SALES = f"stg_sales AS (SELECT {TYPED_COLUMNS} FROM raw_sales)"

# One row per product: the last review id, other columns break ties.
OBT_SALES = """obt_sales AS (SELECT * FROM stg_sales QUALIFY row_number() OVER (PARTITION BY product_id
 ORDER BY review_id DESC NULLS LAST, about_product NULLS LAST, actual_price NULLS LAST, category NULLS LAST,
 discount_percentage NULLS LAST, discounted_price NULLS LAST, img_link NULLS LAST, product_link NULLS LAST,
 product_name NULLS LAST, rating NULLS LAST, rating_count NULLS LAST, review_content NULLS LAST,
 review_id NULLS LAST, review_title NULLS LAST, user_id NULLS LAST, user_name NULLS LAST) = 1)"""

DIM_PRODUCT = """dim_product AS (SELECT DISTINCT product_id, product_name, category, about_product, img_link,
 product_link FROM raw_sales)"""

DIM_USER = "dim_user AS (SELECT DISTINCT user_id, user_name FROM raw_sales)"

DIM_RATING = """dim_rating AS (SELECT user_id, product_id,
 TRY_CAST(replace(rating, ',', '.') AS DECIMAL(3,2)) AS rating,
 TRY_CAST(split_part(replace(rating_count, ',', ''), '.', 1) AS BIGINT) AS rating_count FROM raw_sales)"""

# The definition joins the sales as well, which repeats each rating of a product equally often.
FACT_PRODUCT_RATING = """fact_product_rating AS (
 WITH totals AS (SELECT product_id, SUM(rating) AS total, COUNT(rating) AS rated FROM dim_rating GROUP BY product_id),
 names AS (SELECT DISTINCT product_id, product_name FROM dim_product)
 SELECT product_id, product_name, CAST(total AS DOUBLE) / NULLIF(rated, 0) AS avg_rating
 FROM totals JOIN names USING (product_id) WHERE product_id IN (SELECT product_id FROM raw_sales))"""

# A product or user that has several rows in its dimension counts that often.
FACT_SALES_CATEGORY = """fact_sales_category AS (
 WITH prices AS (SELECT user_id, product_id,
  TRY_CAST(NULLIF(regexp_replace(actual_price, '[^0-9.]', '', 'g'), '') AS DECIMAL(10,2)) AS price FROM raw_sales),
 amounts AS (SELECT user_id, product_id, CAST(SUM(price) AS DECIMAL(18,2)) AS amount FROM prices GROUP BY ALL),
 kinds AS (SELECT product_id, category, CAST(COUNT(*) AS DECIMAL(8,0)) AS times FROM dim_product GROUP BY ALL),
 people AS (SELECT user_id, CAST(COUNT(*) AS DECIMAL(8,0)) AS often FROM dim_user GROUP BY ALL)
 SELECT user_id, category, CAST(SUM(amount * times * often) AS DECIMAL(20,2)) AS sales_amount
 FROM amounts JOIN kinds USING (product_id) JOIN people USING (user_id) GROUP BY ALL)"""

_NEEDS = {
    "raw_sales": [RAW_SALES],
    "stg_sales": [RAW_SALES, STG_SALES],
    "obt_sales": [RAW_SALES, STG_SALES, OBT_SALES],
    "dim_product": [RAW_SALES, DIM_PRODUCT],
    "dim_user": [RAW_SALES, DIM_USER],
    "dim_rating": [RAW_SALES, DIM_RATING],
    "fact_product_rating": [RAW_SALES, DIM_PRODUCT, DIM_RATING, FACT_PRODUCT_RATING],
    "fact_sales_category": [RAW_SALES, DIM_PRODUCT, DIM_USER, FACT_SALES_CATEGORY],
}


def with_tables(names: list[str] | str, query: str) -> str:
    """The query with the derived tables it names before it; a given table needs none."""
    wanted = [names] if isinstance(names, str) else names
    parts = list(dict.fromkeys(text for name in wanted for text in _NEEDS.get(name, [])))
    if not parts:
        return query
    return "WITH " + ",\n".join(p.replace(" AS (", " AS MATERIALIZED (", 1) for p in parts) + "\n" + query


# --------------------------------------------------------------------------- rules


class Check(dict):
    """One SELECT: the columns of a rule row, and ``source`` when it is not the table itself."""


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def select(check: Check, table: str, extra: str = "") -> str:
    return (
        f"SELECT {extra}{text(check['rule'])} AS rule, CAST({text(check['column'])} AS VARCHAR) AS \"column\", "
        f"CAST({check['elements']} AS BIGINT) AS element_count, "
        f"CAST({check['unexpected']} AS BIGINT) AS unexpected_count, "
        f"CAST({check['observed']} AS DOUBLE) AS observed, {check['outcome']} AS outcome "
        f"FROM {check['source'].format(table=table)}"
    )


def all_of(table: str, checks: list[Check], context: str | None = None) -> str:
    label = f"{text(context)} AS context, " if context else ""
    return "\nUNION ALL ".join(
        select(check, table, f"{label}CAST({i} AS INTEGER) AS position, ") for i, check in enumerate(checks, 1)
    )


def rule(name, column, elements="NULL", unexpected="NULL", observed="NULL", outcome="'pass'", source="{table}"):
    return Check(
        rule=name, column=column, elements=elements, unexpected=unexpected, observed=observed, outcome=outcome,
        source=source,
    )


def either(passed: str) -> str:
    return f"CASE WHEN {passed} THEN 'pass' ELSE 'fail' END"


def levels(value: str, fail: str | None = None, warn: str | None = None) -> str:
    """``fail`` and ``warn`` are conditions with ``{v}`` for the value."""
    text_ = "CASE"
    if fail:
        text_ += f" WHEN {fail.format(v=value)} THEN 'fail'"
    if warn:
        text_ += f" WHEN {warn.format(v=value)} THEN 'warn'"
    return text_ + " ELSE 'pass' END"


_NOWHERE = "(SELECT 1) AS nowhere"


def schema(name: str, column: str | None = None, holds: bool = True, observed: str = "NULL") -> Check:
    return rule(name, column, observed=observed, outcome="'pass'" if holds else "'fail'", source=_NOWHERE)


def lacking(name: str, column: str) -> Check:
    return schema(name, column, holds=False)


def rows(passed: str) -> Check:
    return rule("row_count", None, "count(*)", observed="count(*)", outcome=either(passed.format(v="count(*)")))


def broken(name: str, column: str, bad: str, mostly: float | None = None) -> Check:
    """A rule on single values; ``bad`` is false or NULL for those that hold."""
    count = f"count(*) FILTER (WHERE {bad})"
    passed = f"{count} = 0"
    if mostly is not None:
        given = f"count({column})"
        passed = f"{given} = 0 OR CAST({given} - {count} AS DOUBLE) / {given} >= CAST({mostly} AS DOUBLE)"
    return rule(name, column, "count(*)", count, outcome=either(passed))


def not_null(column: str) -> Check:
    return broken("not_null", column, f"{column} IS NULL")


def _share(count: str) -> str:
    return f"(CASE WHEN count(*) > 0 THEN CAST(100 AS DOUBLE) * {count} / count(*) ELSE 0 END)"


def missing(column: str, fail: str | None = None, warn: str | None = None, percent: bool = False) -> Check:
    count = f"count(*) FILTER (WHERE {column} IS NULL)"
    value = _share(count) if percent else count
    return rule("missing", column, "count(*)", count, value, levels(value, fail, warn))


def invalid(column: str, bad: str, fail: str | None = None, warn: str | None = None) -> Check:
    count = f"count(*) FILTER (WHERE {column} IS NOT NULL AND ({bad}))"
    return rule("invalid", column, "count(*)", count, _share(count), levels(_share(count), fail, warn))


def extreme(name: str, column: str, fail: str | None = None, warn: str | None = None) -> Check:
    value = f"{name}({column})"
    return rule(name, column, "count(*)", observed=value, outcome=levels(value, fail, warn))


def _groups(columns: str) -> str:
    return f"(SELECT {columns}, count(*) AS n FROM {{table}} GROUP BY {columns})"


def _any(columns: str) -> str:
    return "(" + " OR ".join(f"{c.strip()} IS NOT NULL" for c in columns.split(",")) + ")"


def _all(columns: str) -> str:
    return "(" + " AND ".join(f"{c.strip()} IS NOT NULL" for c in columns.split(",")) + ")"


_ROWS = "coalesce(sum(n), 0)"


def unique(columns: str, name: str = "unique") -> Check:
    count = f"coalesce(sum(n) FILTER (WHERE n > 1 AND {_any(columns)}), 0)"
    return rule(name, columns, _ROWS, count, outcome=either(f"{count} = 0"), source=_groups(columns))


def uniqueness(column: str, passed: str) -> Check:
    single = f"count(*) FILTER (WHERE n = 1 AND {column} IS NOT NULL)"
    ratio = f"(CASE WHEN {_ROWS} > 0 THEN CAST({single} AS DOUBLE) / {_ROWS} ELSE 1 END)"
    return rule(
        "uniqueness", column, _ROWS, f"{_ROWS} - {single}", ratio, either(passed.format(v=ratio)), _groups(column)
    )


def duplicate_count(columns: str, fail: str | None = None, warn: str | None = None) -> Check:
    count = f"count(*) FILTER (WHERE n > 1 AND {_all(columns)})"
    return rule(
        "duplicate_count", columns, _ROWS, observed=count, outcome=levels(count, fail, warn), source=_groups(columns)
    )


def distinct_between(column: str, low: int, high: int) -> Check:
    count = f"count(DISTINCT {column})"
    return rule(
        "distinct_between", column, "count(*)", observed=count, outcome=either(f"{count} BETWEEN {low} AND {high}")
    )


def references(column: str, parent: str, parent_column: str) -> Check:
    count = (
        f"count(*) FILTER (WHERE {column} IS NOT NULL AND "
        f"{column} NOT IN (SELECT {parent_column} FROM {parent} WHERE {parent_column} IS NOT NULL))"
    )
    return rule("references", column, "count(*)", count, outcome=either(f"{count} = 0"))


def one_number(name: str, query: str, fail: str | None = None, warn: str | None = None) -> Check:
    return rule(name, None, observed="v", outcome=levels("v", fail, warn), source=f"({query}) AS q(v)")


def number_within(query: str, passed: str) -> Check:
    held = f"coalesce({passed.format(v='v')}, false)"
    return rule("contract_sql", None, observed="v", outcome=either(held), source=f"({query}) AS q(v)")


def bad_rows(query: str) -> Check:
    return rule("custom_sql", None, unexpected="count(*)", outcome=either("count(*) = 0"), source=f"({query}) AS q")
