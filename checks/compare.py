"""Run every query on both engines and compare the results: `python -m checks.compare [folder] [query ...]`."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

from checks import oracle, queries
from meterbook.session import local_session


def tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows(columns: list[str], records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in records)


def compare(spark, con, name: str, folder: str) -> tuple[bool, str]:
    df = queries.queries()[name](spark, folder)
    started = time.time()
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    spent = f"{time.time() - started:.1f}s collected,"
    result = con.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {set(names) ^ set(df.columns)}"
    theirs = rows(names, result.fetchall())
    if ours == theirs:
        return True, f"{spent} {sum(ours.values())} rows"
    only, missing = ours - theirs, theirs - ours
    sample = f"\n  columns  {sorted(names)}\n  spark    {next(iter(sorted(only, key=str)), None)}\n  expected {next(iter(sorted(missing, key=str)), None)}"
    return False, f"{sum(ours.values())} rows, {sum(only.values())} only in Spark, {sum(missing.values())} only expected{sample}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries.queries())
    spark, con, failed = local_session(), tables(folder), 0
    for name in wanted:
        started = time.time()
        try:
            good, text = compare(spark, con, name, folder)
        except Exception as error:  # report and go on with the next query
            good, text = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {name} {time.time() - started:.1f}s {text}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
