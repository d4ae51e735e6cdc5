"""Run catalogue queries and their SQL side by side: ``python tests/engine_check.py DIR [names]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value + 0.0 if isinstance(value, float) else value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, row count, value types and every value agree."""
    left_cols, left = _table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right_cols, right = _table([c[0] for c in cursor.description], cursor.fetchall())
    if left_cols != right_cols:
        return [f"columns {left_cols} != {right_cols}"]
    if len(left) != len(right):
        return [f"rows {len(left)} != {len(right)}"]
    out = []
    for a, b in zip(left, right):
        for name, x, y in zip(left_cols, a, b):
            if x != y or type(x) is not type(y):
                out.append(f"{name}: {x!r} ({type(x).__name__}) != {y!r} ({type(y).__name__}) in {a}")
    return out


if __name__ == "__main__":
    from conftest import make_session

    from __spark_entry__ import oracle_sql, queries

    folder, names = sys.argv[1], sys.argv[2:]
    spark, con, sql = make_session(), connect(folder), oracle_sql()
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            found = differences(df, con, sql[name]) if name in sql else [f"no SQL, {df.count()} rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        state = "ok" if not found else f"{len(found)} differences"
        print(f"{name:26s} {time.time() - start:6.2f}s {state}", flush=True)
        for line in found[:3]:
            print("     ", line, flush=True)
