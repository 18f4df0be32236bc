"""Compare registered queries with their SQL on one scale. Usage: oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _type(value) -> str:
    return type(value).__name__


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> list[str]:
    """Problems found, empty when rows, columns, python types and values agree exactly."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want_raw = rel.fetchall()
    if sorted(names) != cols:
        return [f"{name}: columns {cols} != {sorted(names)}"]
    order = [names.index(c) for c in cols]
    want = [tuple(r[i] for i in order) for r in want_raw]
    problems = []
    if len(got) != len(want):
        problems.append(f"{name}: rows {len(got)} != {len(want)}")
    for i, c in enumerate(cols):
        a = {_type(r[i]) for r in got} - {"NoneType"}
        b = {_type(r[i]) for r in want} - {"NoneType"}
        if got and want and a != b:
            problems.append(f"{name}.{c}: types {a} != {b}")
    a = sorted(tuple(_plain(v) for v in r) for r in got)
    b = sorted(tuple(_plain(v) for v in r) for r in want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        problems.append(f"{name}: values differ {cols} {diff}")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from runlens import get_spark

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    only = args[1:]
    spark = get_spark("local[8]", shuffle_partitions=8,
                      extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in oracles:
                problems = compare(spark, con, name, fn, oracles[name], sf_dir)
                n = con.execute(f"SELECT count(*) FROM ({oracles[name]})").fetchone()[0]
            else:
                n = fn(spark, sf_dir).count()
                problems = [] if n else [f"{name}: no rows"]
        except Exception as e:  # report every query, not only the first failure
            problems = [f"{name}: {type(e).__name__} {str(e)[:1500]}"]
            n = -1
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {time.time() - start:6.2f}s {n:7d} rows {name}", *problems, sep="\n     ", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
