"""Compare every named query with its SQL in DuckDB. Also a script: `python tests/oracle_check.py [sf_dir] [name ...]`."""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, query, sql):
    """None when both sides agree, else what differs."""
    frame = query(spark, sf_dir)
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if not want[1]:
        return "no rows to compare"
    if got[1] != want[1]:
        only = [r for r in got[1] if r not in set(want[1])][:3], [r for r in want[1] if r not in set(got[1])][:3]
        return f"rows {len(got[1])} / {len(want[1])}; only here {only[0]}; only there {only[1]}"
    return None


def main(sf_dir="/root/testdata/sf0.001", *names):
    from __spark_entry__ import oracle_sql, queries
    from larderlens import local_session

    spark, con, sql = local_session(8), connect(sf_dir), oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = compare(spark, con, sf_dir, query, sql[name]) or "ok"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {error}"[:1500]
        print(f"{name:28} {time.time() - start:6.2f}s {result}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
