"""Run registered queries next to their SQL in DuckDB and compare the rows.

    python -m tests.oracle [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value == int(value) and abs(value) < 1e15 else value
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark_df, con, sql):
    """None when equal, else a short text on the first difference."""
    a_cols, a = sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    b_cols, b = sorted_rows([d[0] for d in cur.description], cur.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} != {b_cols}", len(a)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}: {sorted(set(a) ^ set(b), key=repr)[:4]}", len(a)
    for x, y in zip(a, b):
        if x != y:
            bad = sum(1 for p, q in zip(a, b) if p != q)
            return f"{bad} of {len(a)} rows differ: {a_cols} {x} != {y}", len(a)
    return None, len(a)


def main(argv):
    from tidemark.session import build_session
    from __spark_entry__ import oracle_sql, queries

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = build_session("oracle", 8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls, bad = oracle_sql(), []
    for name in names:
        began = time.time()
        try:
            df = queries()[name](spark, folder)
            if name in sqls:
                problem, n = compare(df, con, sqls[name])
            else:
                problem, n = None, len(df.collect())
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", 0
        state = "ok  " if problem is None else "FAIL"
        kind = "sql" if name in sqls else "rows only"
        print(f"{state} {name:28s} {n:7d} rows {time.time() - began:6.2f}s {kind}", flush=True)
        if problem:
            print("     ", problem[:1200], flush=True)
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} agree; failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
