"""Run a registered query and its SQL equivalent and compare the rows.

``python -m tests.compare [folder] [name …]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def differences(df, con, sql: str) -> str | None:
    """None when both sides have the same columns, types and rows."""
    names = sorted(df.columns)
    rows = sorted([tuple(plain(r[n]) for n in names) for r in df.collect()], key=sort_key)
    relation = con.sql(sql)
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(relation.columns) != names:
        return f"columns {names} and {sorted(relation.columns)}"
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} and {kinds[name]}"
    at = [relation.columns.index(n) for n in names]
    expected = sorted([tuple(plain(r[i]) for i in at) for r in relation.fetchall()], key=sort_key)
    if len(rows) != len(expected):
        return f"{len(rows)} rows and {len(expected)}"
    wrong = [(a, b) for a, b in zip(rows, expected) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows)} rows differ, such as {wrong[0]}"
    return None


def main() -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tests.conftest import make_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con = make_session(), connect(folder)
    oracles, bad = entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in oracles:
                found = differences(df, con, oracles[name]) or "ok"
            else:
                found = f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += not (found == "ok" or found.startswith("no SQL"))
        print(f"{name:40s} {time.time() - start:6.2f}s  {found}", flush=True)
    print(f"{bad} wrong")


if __name__ == "__main__":
    main()
