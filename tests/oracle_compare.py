"""Compare registered Spark queries with their DuckDB oracle statements.

Mirrors the driver's check: same column names, same row count, and equal
multisets of rows after sorting columns by name and normalising values.
Usable from pytest and as a script: ``python tests/oracle_compare.py [sf_dir] [names...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())


def compare(spark, con, name, query, sql, sf_dir):
    sc, srows = spark_rows(query(spark, sf_dir))
    dc, drows = duck_rows(con, sql)
    problems = []
    if sc != dc:
        problems.append(f"columns {sc} != {dc}")
    n_s, n_d = sum(srows.values()), sum(drows.values())
    if n_s != n_d:
        problems.append(f"rows {n_s} != {n_d}")
    if sc == dc and srows != drows:
        only_s = list((srows - drows).elements())[:3]
        only_d = list((drows - srows).elements())[:3]
        problems.append(f"values differ; spark-only {only_s}; duck-only {only_d}")
    return n_s, problems


def main(argv):
    from fieldload.session import build_session

    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows", flush=True)
            continue
        n, problems = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        if problems:
            bad += 1
            print(f"FAIL {name} ({n} rows): " + " | ".join(problems), flush=True)
        else:
            print(f"ok   {name} ({n} rows)", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def type_mismatches(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    st = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rel = con.sql(sql)
    dt_ = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    out = []
    for c, t in st.items():
        want = SPARK_TO_DUCK.get(t, t)
        if c in dt_ and dt_[c] != want:
            out.append(f"{c}: spark {t} vs duck {dt_[c]}")
    return out
