"""Run a registered query in Spark and its oracle SQL in DuckDB, and compare.

Comparison: same column names and types, same row count, same multiset of rows
(order-insensitive; floats rounded). Usable from pytest and as a script::

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


# Spark type -> DuckDB type of the same values.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_types = {c[0]: str(c[1]) for c in res.description}
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{name}: columns {s_cols} vs {d_cols}"
    for c in s_cols:
        if SAME_TYPE.get(s_types[c], s_types[c]) != d_types[c]:
            return False, f"{name}: column {c} is {s_types[c]} in Spark but {d_types[c]} in DuckDB"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows {len(s_rows)} vs {len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = list((a - b).items())[:3], list((b - a).items())[:3]
        return False, f"{name}: values differ; spark-only/duck-only samples {diff}"
    return True, f"{name}: ok ({len(s_rows)} rows)"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from wordfold.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = local_session(8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"{n}: no oracle; {df.count()} rows, columns {df.columns}")
            continue
        ok, msg = compare(spark, n, qs[n], sqls[n], sf_dir, con)
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
