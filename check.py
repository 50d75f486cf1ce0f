"""Run every registered query against its DuckDB twin.

    python check.py [data folder] [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb

from quirebind.session import local_session
from quirebind.workload.oracle import ORACLE
from quirebind.workload.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def compare(spark, con, name: str, folder: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if name not in ORACLE:
        return True, f"{len(ours)} rows, no twin, {took:.1f} s"
    start = time.time()
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    theirs = rows_of(columns, result.fetchall())
    note = f"{len(ours)} rows, {took:.1f} s / {time.time() - start:.1f} s"
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(columns)}"
    if ours != theirs:
        ours_only = [r for r in ours if r not in set(theirs)][:2]
        theirs_only = [r for r in theirs if r not in set(ours)][:2]
        return False, f"{note} / {len(theirs)} rows\n  ours   {ours_only}\n  theirs {theirs_only}"
    return True, note


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(folder)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        try:
            good, note = compare(spark, con, name, folder)
        except Exception as e:  # report and go on with the next query
            good, note = False, f"{type(e).__name__}: {str(e)[:500]}"
        failed += not good
        print("ok  " if good else "FAIL", name, note, flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
