"""Compare registered queries with their SQL: ``python tests/check.py SF_DIR [NAME ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_columns, got = canonical(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    want_columns, want = canonical([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a} != {b}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from stopwise.session import build_session
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            found = compare(df, con, sql[name]) if name in sql else f"rows {len(df.collect())}"
            wrong = found is not None and name in sql
        except Exception as error:
            found, wrong = f"{type(error).__name__}: {str(error)[:600]}", True
        bad += wrong
        print(f"{'BAD' if wrong else 'ok '} {name} {time.time() - start:.1f}s {found or ''}",
              flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
