"""Spark result against SQL result, whatever the order of rows and columns."""

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    """A value with its kind, so that 1, 1.0 and '1' stay apart."""
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"float {value!r}"
    if isinstance(value, decimal.Decimal):
        return f"decimal {value.normalize():f}"
    if isinstance(value, datetime.datetime):
        return f"time {value.isoformat()}"
    return f"{type(value).__name__} {value!r}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    """None if both results are equal, else a short account of what differs."""
    found = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    wanted = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if found[0] != wanted[0]:
        return f"columns {found[0]} != {wanted[0]}"
    if found[1] == wanted[1]:
        return None
    only_spark = sorted(set(found[1]) - set(wanted[1]))[:3]
    only_sql = sorted(set(wanted[1]) - set(found[1]))[:3]
    return f"{len(found[1])} rows, {len(wanted[1])} in SQL; {found[0]}; only Spark {only_spark}; only SQL {only_sql}"
