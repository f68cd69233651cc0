"""Run every query on Spark and its SQL on DuckDB over the same tables, and compare.

    python tools/check_queries.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

from smeltwork.queries import ALL
from smeltwork.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _rows(columns: list[str], rows: list) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, connection, sf_dir: str, name: str) -> tuple[bool, str]:
    query = ALL[name]
    start = time.time()
    frame = query.run(spark, sf_dir)
    columns, got = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    took = time.time() - start
    if query.sql is None:
        return True, f"{len(got)} rows, no SQL, {took:.1f}s"
    relation = connection.sql(query.sql)
    names, want = _rows(relation.columns, relation.fetchall())
    if columns != names:
        return False, f"columns {columns} != {names}"
    if got != want:
        extra = [row for row in got if row not in set(want)][:2]
        lacking = [row for row in want if row not in set(got)][:2]
        return False, f"{len(got)} rows != {len(want)} rows\n   spark only: {extra}\n   sql only:   {lacking}"
    return True, f"{len(got)} rows, {took:.1f}s"


def main() -> int:
    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    spark = local_session(8)
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    failures = 0
    for name in arguments or ALL:
        try:
            good, note = compare(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failures += not good
        print(f"{'ok  ' if good else 'FAIL'} {name}: {note}", flush=True)
    print(f"{failures} failed")
    return 1 if failures else 0


if __name__ == "__main__":
    raise SystemExit(main())
