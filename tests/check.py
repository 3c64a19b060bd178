"""Compare registered queries with their SQL in DuckDB: names, types, values.

python tests/check.py [--sf 0.01] [query ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from cohortloom.session import build_session, drop_settled  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Spark type name -> DuckDB type name
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b
    return a == b and type(a) is type(b)


def compare(df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    names = sorted(df.columns)
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    ours = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=key)
    rel = con.execute(sql)
    described = [(d[0], str(d[1])) for d in rel.description]
    if sorted(d[0] for d in described) != names:
        return f"columns {sorted(set(names) ^ {d[0] for d in described})}"
    wrong = {n: (types[n], t) for n, t in described if types[n] != t}
    if wrong:
        return f"types {wrong}"
    place = {d[0]: i for i, d in enumerate(described)}
    theirs = sorted((tuple(plain(r[place[n]]) for n in names) for r in rel.fetchall()), key=key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if not all(close(x, y) for x, y in zip(a, b)):
            diff = {n: (x, y) for n, x, y in zip(names, a, b) if not close(x, y)}
            return f"values {diff} in {dict(zip(names, a))}"[:600]
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__driver__host="127.0.0.1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in args.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                built = time.time() - start
                problem = compare(df, con, oracles[name])
                n = f"build {built:.1f}"
            else:
                problem, n = None, f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:900]}", ""
        bad += problem is not None
        drop_settled(spark)
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {n} {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
