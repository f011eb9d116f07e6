"""Compare every query with its SQL oracle: ``python tests/check_oracles.py [sf_dir] [name …]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as contract
from stayline.sources.tables import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, int(value))
    if isinstance(value, (int, float)):
        value = float(value)
        return (2, "nan") if math.isnan(value) else (1, value)
    return (3, str(value))


def normal(rows, columns):
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, float]:
    start = time.time()
    df = contract.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return (f"rows {len(got)}" if got else "EMPTY"), took
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {df.columns} != {columns}", took
    if len(got) != len(want):
        return f"COUNT {len(got)} != {len(want)}", took
    a, b = normal(got, df.columns), normal(want, columns)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    types = {c: (t, str(d[1])) for (c, t), d in zip(sorted(df.dtypes), sorted(cursor.description))}
    odd = {c: t for c, t in types.items() if "HUGEINT" in t[1] or "DECIMAL" in t[1]
           or {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT"}.get(t[0]) != t[1]}
    if bad:
        return f"VALUES {len(bad)} of {len(a)} differ, first {bad[0]}", took
    return f"ok {len(a)}" + (f" types {odd}" if odd else ""), took


def main() -> None:
    from stayline import session

    args = sys.argv[1:]
    sf_dir = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    names = [a for a in args if "/" not in a] or list(contract.queries())
    spark = session.build("oracles", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        try:
            result, took = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            result, took = f"ERROR {type(error).__name__}: {str(error)[:600]}", 0.0
        failed += not result.startswith(("ok", "rows"))
        print(f"{name:32s} {took:6.1f}s {result}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
