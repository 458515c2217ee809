"""Run registered queries beside their SQL and compare all rows."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both results are equal, else what differs."""
    df = query(spark, sf_dir)
    ours = _ordered(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = _ordered(columns, result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{ours[0]}: {a} against {b}"
    return None if ours[1] else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from ridelabel.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if name not in sqls or names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, query, sqls[name])
        except Exception as e:  # report and go on with the next query
            problem = "ERROR " + str(e)[:600]
        print(f"{name:24s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
