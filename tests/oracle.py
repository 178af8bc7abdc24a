"""Compare a query with its SQL counterpart on the given tables."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    fixed = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(fixed, key=lambda row: [_sort_key(v) for v in row])


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _sort_key(value):
    return (0, "") if value is None else (1, f"{value:020.6f}") if isinstance(value, (int, float)) else (2, str(value))


def run_sql(con, sql):
    cursor = con.execute(sql)
    return [item[0] for item in cursor.description], [str(item[1]) for item in cursor.description], cursor.fetchall()
