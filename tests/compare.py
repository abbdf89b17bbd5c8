"""Comparison of a Spark result with the oracle's, row for row."""

from __future__ import annotations

import decimal
from collections import Counter

import duckdb

from corvane.plans.tables import TABLE_NAMES


def oracle_connection(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimal in a flat result")
    return repr(value)


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark types and what the oracle calls them.
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def differences(df, connection, sql) -> str | None:
    """None if equal, else a short account of what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = dict(connection.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    unlike = {n: (t, kinds[n]) for n, t in df.dtypes if TYPES[t] != kinds[n]}
    if unlike:
        return f"types {unlike}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == expected:
        return None
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} rows, expected {sum(expected.values())}; "
        f"extra {sum(extra.values())}: {str(list(extra)[:2])[:600]}; "
        f"missing {sum(missing.values())}: {str(list(missing)[:2])[:600]}"
    )
