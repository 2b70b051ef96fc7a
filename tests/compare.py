"""Run registered queries on Spark and DuckDB and compare whole results. Usage: python tests/compare.py [sf] [prefix ...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from gristmill.sources.tables import TABLES

TESTDATA = "/root/testdata"


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((repr([plain(r[i]) for i in order]) for r in rows))


def oracle(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, name, build, sql, folder):
    """None when equal, else a short text."""
    df = build(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if rows else "no rows"
    cursor = con.execute(sql)
    other_columns = [c[0] for c in cursor.description]
    a_cols, a = normal(df.columns, rows)
    b_cols, b = normal(other_columns, cursor.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} / {b_cols}"
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"rows {len(a)}/{len(b)}; spark only {only_a}; duckdb only {only_b}"
    return None if a else "no rows"


def main(sf: str, prefixes: list[str]) -> int:
    import __spark_entry__ as entry
    from gristmill.session import build

    spark = build("compare", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"{TESTDATA}/sf{sf}"
    con, sql, bad = oracle(folder), entry.oracle_sql(), 0
    for name, build_query in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, build_query, sql.get(name), folder)
        except Exception as error:  # noqa: BLE001  (report and go on)
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {'' if name in sql else '(rows only) '}{problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1] if len(sys.argv) > 1 else "0.001", sys.argv[2:]) else 0)
