"""Compare a Spark result with DuckDB's: same columns, same rows in any order, same values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimal in a result")
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(_plain(row[i])).__name__, _plain(row[i])) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    out = []
    if sum(actual.values()) != sum(expected.values()):
        out.append(f"rows {sum(actual.values())} != {sum(expected.values())}")
    out += [f"only spark: {row}" for row in list((actual - expected).elements())[:3]]
    out += [f"only duckdb: {row}" for row in list((expected - actual).elements())[:3]]
    return out
