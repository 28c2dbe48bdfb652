"""Runs registered queries next to their SQL and reports every difference.

``python tests/oracle_compare.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _kind(arrow_type) -> str:
    name = str(arrow_type)
    return {"large_string": "string"}.get(name, name)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences in column names, types, row count and values; empty if equal."""
    ours, theirs = spark_df.toArrow(), con.execute(sql).to_arrow_table()
    names = sorted(ours.column_names)
    if names != sorted(theirs.column_names):
        return [f"columns {names} != {sorted(theirs.column_names)}"]
    problems = []
    for n in names:
        a, b = _kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)
        if a != b:
            problems.append(f"type of {n}: {a} != {b}")
    if ours.num_rows != theirs.num_rows:
        problems.append(f"rows {ours.num_rows} != {theirs.num_rows}")
    sides = []
    for table in (ours, theirs):
        columns = [table.column(n).to_pylist() for n in names]
        sides.append(sorted(tuple(_cell(v) for v in row) for row in zip(*columns)))
    differing = [(a, b) for a, b in zip(*sides) if a != b]
    if differing:
        a, b = differing[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        problems.append(f"{len(differing)} rows differ, first: {cells}")
    return problems


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as driver
    from siltworks.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), driver.oracle_sql(), 0
    chosen = sys.argv[2:]
    for name, run in driver.queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            problems = compare(df, con, oracles[name]) if name in oracles else []
            note = "" if name in oracles else f" rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problems, note = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s{note} {'; '.join(problems)}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
