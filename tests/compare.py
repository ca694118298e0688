"""Run queries here and in DuckDB on the same tables and compare the rows."""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def rows_of(columns, rows):
    """Rows with columns in name order, as a sorted list of plain texts."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, con, run, sql: str, sf_dir: str) -> str:
    """'' when both engines agree, else what differs."""
    df = run(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if ours != theirs:
        a, b = set(ours) - set(theirs), set(theirs) - set(ours)
        return f"{len(ours)} rows != {len(theirs)}; here only {sorted(a)[:2]}; there only {sorted(b)[:2]}"
    return "" if ours else "EMPTY"


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import session

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark, con = session(), duckdb_views(sf_dir)
    sql = entry.oracle_sql()
    missing = sorted(set(sql) ^ set(entry.queries()))
    print("without a partner:", missing)
    for key, run in entry.queries().items():
        if chosen and key not in chosen:
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, run, sql[key], sf_dir) or "ok"
        except Exception as error:
            verdict = "ERROR " + " ".join(str(error).split())[:600]
            if chosen:
                traceback.print_exc()
        print(f"{time.time() - start:6.2f}s {key}: {verdict}", flush=True)


if __name__ == "__main__":
    main()
