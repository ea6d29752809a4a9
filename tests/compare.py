"""Compare registered queries with their SQL twins in DuckDB."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def duckdb_rows(sql: str, folder: str) -> tuple[list[str], Counter]:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return _bag(names, result.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return _bag(df.columns, [tuple(row) for row in df.collect()])


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)
