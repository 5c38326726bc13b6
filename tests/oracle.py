"""Row-by-row comparison of a registered query with its SQL."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {table.stem} as select * from read_parquet('{table}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else (None if math.isnan(value) else value)
    return bytes(value) if isinstance(value, bytearray) else value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, connection, sql):
    """Problems found; empty if both sides hold the same rows under the same names."""
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    wanted, got = _bag(names, cursor.fetchall()), _bag(df.columns, df.collect())
    missing, extra = wanted - got, got - wanted
    if not missing and not extra:
        return []
    return [
        f"{sum(wanted.values())} rows wanted, {sum(got.values())} found",
        f"missing {list(missing.items())[:3]}",
        f"extra {list(extra.items())[:3]}",
    ]
