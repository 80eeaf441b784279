"""Run a query in Spark and its SQL in DuckDB and compare rows, order aside."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    """One form per value, whatever engine it came from."""
    if isinstance(value, Decimal):
        return ("n", format(value.normalize(), "f") if value else "0")
    if isinstance(value, bool) or value is None:
        return ("b", str(value))
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else repr(value))
    if isinstance(value, int):
        return ("i", str(value))
    if isinstance(value, (dt.datetime, dt.date)):
        return (type(value).__name__, value.isoformat())
    return ("s", str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql) -> str | None:
    cursor = con.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    expected = rows_of(sql_names, cursor.fetchall())
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(sql_names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(sql_names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows vs {len(expected)}"
    for a, b in zip(actual, expected):
        if a != b:
            return f"first difference\n  spark {a}\n  sql   {b}"
    return None
