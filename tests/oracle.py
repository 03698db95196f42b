"""Compare every registered query with its SQL on DuckDB: ``python tests/oracle.py [sf_dir] [names...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, run, sql):
    """``None`` when both sides agree, else what differs."""
    made = run(spark, sf_dir)
    ours = rows_of(made.columns, [tuple(r) for r in made.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(made.columns) != sorted(names):
        return f"columns {sorted(made.columns)} / {sorted(names)}"
    if ours != theirs:
        only_ours, only_theirs = sorted(set(ours) - set(theirs))[:3], sorted(set(theirs) - set(ours))[:3]
        return f"{len(ours)} / {len(theirs)} rows; only here {only_ours}; only oracle {only_theirs}"
    return None


def main() -> int:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from orgloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark, con, bad = local_session("oracle"), connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name])
        except Exception as error:  # report all queries, not only the first failure
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name}: {'ok' if problem is None else problem} ({time.time() - start:.1f} s)", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
