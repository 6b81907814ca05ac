"""Compare a Spark result with a DuckDB result: names, row count, values as a multiset."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str, show: int = 3) -> str:
    """Empty when equal, else a short description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    want = _rows(names, cursor.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if want == got:
        return ""
    extra = [r for r in got if r not in set(want)][:show]
    missing = [r for r in want if r not in set(got)][:show]
    return f"{len(got)} rows vs {len(want)}; only in Spark {extra}; only in SQL {missing}"
