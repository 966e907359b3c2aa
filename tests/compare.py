"""Run registered queries next to their SQL and compare the rows.

    python tests/compare.py [--sf /root/testdata/sf0.01] [name …]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(rows, key=repr)


# Types that hold the same values in both engines.
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "FLOAT": "float", "TIMESTAMP": "timestamp",
}


def compare(spark, con, folder, query, sql) -> tuple[str, int, float, float]:
    start = time.time()
    df = query(spark, folder)
    ours = [tuple(row) for row in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return ("rows only" if ours else "EMPTY"), len(ours), seconds, 0.0
    start = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    theirs = result.fetchall()
    sql_seconds = time.time() - start
    a, b = ordered(df.columns, ours), ordered(names, theirs)
    if a[0] != b[0]:
        return f"COLUMNS {a[0]} / {b[0]}", len(ours), seconds, sql_seconds
    if a[1] != b[1]:
        odd = [(x, y) for x, y in zip(a[1], b[1]) if x != y][:2]
        return f"VALUES {len(a[1])} / {len(b[1])} rows {str(odd)[:700]}", len(ours), seconds, sql_seconds
    ours_kinds = dict(df.dtypes)
    wrong = {k: (ours_kinds[k], v) for k, v in kinds.items() if ours_kinds[k] != v}
    status = "equal" if ours else "EMPTY"
    return (f"{status}, types {wrong}" if wrong else status), len(ours), seconds, sql_seconds


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    import __spark_entry__ as entry
    from corpusflow.session import local_session

    spark, con = local_session(), connect(args.sf)
    queries, oracles, bad = entry.queries(), entry.oracle_sql(), 0
    for name in args.names or queries:
        try:
            status, rows, seconds, sql_seconds = compare(spark, con, args.sf, queries[name], oracles.get(name))
        except Exception as error:  # noqa: BLE001
            status, rows, seconds, sql_seconds = f"ERROR {type(error).__name__}: {str(error)[:900]}", 0, 0.0, 0.0
        bad += status not in ("equal", "rows only")
        print(f"{name:32} {rows:8} rows {seconds:7.2f} s (sql {sql_seconds:6.2f} s)  {status}", flush=True)
    print(f"{bad} to look at")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
