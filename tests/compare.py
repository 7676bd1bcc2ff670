"""Spark result against DuckDB result: names, kinds of type, and rows regardless of order."""

from __future__ import annotations

import collections
import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    return value


KINDS = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def differences(spark_df, con, sql: str) -> list[str]:
    found = []
    result = con.execute(sql)
    duck_kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    spark_kinds = dict(spark_df.dtypes)
    if duck_kinds != spark_kinds:
        both = sorted(set(duck_kinds) | set(spark_kinds))
        found += [f"{n}: spark {spark_kinds.get(n)} duck {duck_kinds.get(n)}" for n in both if spark_kinds.get(n) != duck_kinds.get(n)]
    names = sorted(spark_kinds)
    if set(duck_kinds) != set(spark_kinds):
        return found
    order = [list(duck_kinds).index(n) for n in names]
    left = collections.Counter(tuple(plain(row[n]) for n in names) for row in spark_df.collect())
    right = collections.Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    if left != right:
        found.append(f"rows: spark {sum(left.values())} duck {sum(right.values())}")
        found += [f"only spark: {dict(zip(names, row))}" for row in list((left - right))[:2]]
        found += [f"only duck: {dict(zip(names, row))}" for row in list((right - left))[:2]]
    return found
