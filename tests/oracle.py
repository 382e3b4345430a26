"""Run registered queries beside their SQL: ``python tests/oracle.py [-d DIR] [name …]``."""

from __future__ import annotations

import argparse
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads = 8")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con) -> str | None:
    """None when the results agree, else what differs."""
    df = query(spark, sf_dir)
    columns, got = normal(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_columns, expected = normal(names, cursor.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if not expected:
        return "the SQL gives no rows"
    if got != expected:
        extra = [r for r in got if r not in set(expected)][:2]
        missing = [r for r in expected if r not in set(got)][:2]
        return f"{len(got)} rows against {len(expected)}; only here {extra}; only SQL {missing}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from martloom.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("-d", "--dir", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    picked = args.parse_args()
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(picked.dir), oracle_sql(), 0
    for name, query in queries().items():
        if picked.names and name not in picked.names:
            continue
        began = time.time()
        try:
            problem = compare(spark, picked.dir, name, query, sql.get(name), con)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        kind = "" if name in sql else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{kind} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
