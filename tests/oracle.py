"""Run queries next to their SQL in DuckDB and compare schema and rows."""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402

DATA = "/root/testdata"
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
    "float": "FLOAT", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    db = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS FROM '{sf_dir}/{file}'")
    return db


def compare(spark, db, name, sf_dir, scratch):
    """Problems found, empty when both sides agree."""
    df = entry.queries()[name](spark, sf_dir)
    out = f"{scratch}/{name}"
    df.write.parquet(out)
    db.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS {entry.oracle_sql()[name]}")
    db.execute(f"CREATE OR REPLACE TEMP TABLE ours AS FROM '{out}/*.parquet'")
    want = dict(db.execute("SELECT column_name, column_type FROM (DESCRIBE theirs)").fetchall())
    have = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema}
    if want != have:
        return [f"schema {have} wanted {want}"]
    columns = ", ".join(f'"{c}"' for c in sorted(have))
    problems = []
    for a, b in (("ours", "theirs"), ("theirs", "ours")):
        extra = f"(SELECT {columns} FROM {a} EXCEPT ALL SELECT {columns} FROM {b})"
        count = db.execute(f"SELECT count(*) FROM {extra}").fetchall()[0][0]
        if count:
            sample = db.execute(f"FROM {extra} LIMIT 2").fetchall()
            problems.append(f"{count} rows only in {a}, such as {sample}")
    return problems


if __name__ == "__main__":
    import tempfile

    from raceway.session import get_session

    sf_dir = f"{DATA}/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    names = sys.argv[2:] or list(entry.queries())
    session = get_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    database, scratch = connect(sf_dir), tempfile.mkdtemp(prefix="oracle-")
    failed = 0
    for query_name in names:
        start = time.time()
        found = compare(session, database, query_name, sf_dir, scratch)
        failed += bool(found)
        print(f"{query_name:28s} {time.time() - start:6.2f}s {'ok' if not found else found}", flush=True)
    print("failed:", failed)
