"""Compare registered queries with their SQL on DuckDB.

python tests/oracle_check.py [folder] [name or prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


SPARK_SECONDS = 0.0


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        cells = []
        for i in order:
            v = row[i]
            if isinstance(v, float) and v != v:
                v = None
            if isinstance(v, float):
                v = v + 0.0  # -0.0 equals 0.0
            cells.append(v)
        out.append(tuple(cells))
    return sorted(out, key=repr)


def compare(spark, con, folder: str, build, sql: str) -> str | None:
    """None if equal, else what differs."""
    global SPARK_SECONDS
    start = time.time()
    df = build(spark, folder)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    SPARK_SECONDS = time.time() - start
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    theirs = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = {c: (t, types[c]) for c, t in df.dtypes if SPARK_TO_SQL.get(t, t) != types[c]}
    if wrong:
        return f"types {wrong}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    if not mine:
        return "no rows"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    return None


def main() -> int:
    from tidemill.queries import catalog
    from tidemill.session import local_session

    args = sys.argv[1:]
    folder = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("ZONE", "UTC"))
    con = connect(folder)
    failed = 0
    for name, build in catalog.QUERIES.items():
        if args and not any(name == a or name.startswith(a) for a in args):
            continue
        start = time.time()
        try:
            if name in catalog.ORACLES:
                problem = compare(spark, con, folder, build, catalog.ORACLES[name])
                note = "ok" if problem is None else problem
            else:
                n = build(spark, folder).count()
                problem = None if n else "no rows"
                note = f"rows only: {n}"
        except Exception as error:
            if os.environ.get("TRACE"):
                raise
            problem = note = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'pass'} {time.time() - start:6.1f}s (spark {SPARK_SECONDS:.1f}s) {name}: {note}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    pd.options.display.width = 200
    raise SystemExit(main())
