"""Run queries against their SQL: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "float": "FLOAT"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(value):
    if value is None:
        return "\0null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def compare(spark, con, sf_dir: str, name: str) -> list[str]:
    """Differences between a query and its SQL; empty when they agree."""
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = [tuple(cell(v) for v in r) for r in zip(*df.select(*columns).toArrow().to_pydict().values())]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return [] if rows else ["no rows"]
    rel = con.sql(sql)
    problems = []
    if sorted(rel.columns) != columns:
        return [f"columns {columns} and {sorted(rel.columns)}"]
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    for c in columns:
        want = TYPES.get(df.schema[c].dataType.simpleString(), "?")
        if kinds[c] != want:
            problems.append(f"type of {c}: {want} and {kinds[c]}")
    other = [tuple(cell(v) for v in r) for r in con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM rel").fetchall()]
    if len(rows) != len(other):
        problems.append(f"rows {len(rows)} and {len(other)}")
    a, b = sorted(rows), sorted(other)
    if a != b:
        mine, theirs = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        problems.append(f"values {str(mine)[:600]} and {str(theirs)[:600]}")
    return problems


def main():
    from lorefield.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name in args or entry.queries():
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, name)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:900]}"]
        bad += bool(problems)
        kind = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'ok ' if not problems else 'BAD'} {kind:4} {time.time() - start:6.2f}s {name}", *problems, sep="\n      " if problems else "", flush=True)
    print(f"{bad} of {len(args or entry.queries())} differ")


if __name__ == "__main__":
    main()
