"""Compare registered queries with their SQL forms in DuckDB.

Run as a script: ``python tests/oracle.py [sf dir] [name part ...]``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def sorted_rows(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(spark, con, folder: str, query) -> tuple[int, str]:
    """Row count and '' or the first difference."""
    df = query.run(spark, folder)
    columns = sorted(df.columns)
    ours = sorted_rows(df.select(*[f"`{c}`" for c in columns]).collect())
    if query.sql is None:
        return len(ours), "" if ours else "no rows"
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted_rows(con.execute(f"SELECT {quoted} FROM ({query.oracle()})").fetchall())
    if len(ours) != len(theirs):
        return len(ours), f"{len(ours)} rows, expected {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return len(ours), f"{a} expected {b}"
    return len(ours), ""


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    from wardflow import registry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    for setting in filter(None, os.environ.get("SETTINGS", "").split(",")):
        session.conf.set(*setting.split("="))
    connection = connect(folder)
    bad = 0
    for name, query in registry.ALL.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            n, problem = compare(session, connection, folder, query)
        except Exception as error:  # noqa: BLE001
            n, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "sql" if query.sql else "rows"
        print(f"{name:36s} {kind:4s} {n:7d} {time.time() - start:6.2f}s {problem[:900]}", flush=True)
    print("failed:", bad)
