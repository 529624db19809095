"""Runs catalogue queries in Spark and in DuckDB and compares the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float) and math.isnan(value):
        return (0, "nan")
    if isinstance(value, (int, float)):
        return (2, repr(round(float(value), 9) + 0.0))
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """Returns (ok, message)."""
    start = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if sql is None:
        return True, f"{len(got)} rows, no SQL, {spent:.1f}s"
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = result.fetchall()
    types = [str(c[1]) for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if len(a) != len(b):
        return False, f"{len(a)} rows != {len(b)}"
    if a != b:
        i = next(i for i in range(len(a)) if a[i] != b[i])
        bad = sum(x != y for x, y in zip(a, b))
        return False, f"{bad} of {len(a)} rows differ: {sorted(df.columns)}\n   spark {a[i]}\n   duck  {b[i]}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    duck_kinds = dict(zip(columns, types))
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [f"{c}:{kinds[c]}/{duck_kinds[c]}" for c in columns if same.get(kinds[c]) != duck_kinds[c]]
    return True, f"{len(a)} rows, {spent:.1f}s" + (f"  TYPES {odd}" if odd else "")


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from riskflow.session import local_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark, con = local_session(), duck(sf)
    sqls = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        try:
            ok, message = compare(spark, con, name, query, sqls.get(name), sf)
        except Exception as error:  # report and go on with the next query
            ok, message = False, f"{type(error).__name__}: {str(error)[:900]}"
        failed += not ok
        print("ok  " if ok else "FAIL", name, message, flush=True)
    print("failed", failed)
