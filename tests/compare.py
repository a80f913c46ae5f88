"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with their columns by name, in a fixed order."""
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in places) for row in rows), key=repr)


def difference(spark_df, sql: str, con) -> str | None:
    """None when both sides agree, else the first thing that differs."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"{a!r} != {b!r}"
    return None


def main(sf: str, only: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from moodline.session import local_session

    spark, sf_dir = local_session(), f"/root/testdata/sf{sf}"
    con, sql = duck(sf_dir), oracle_sql()
    for name, query in queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            verdict = difference(query(spark, sf_dir), sql[name], con) or "same"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {error}"
        print(f"{name:28} {time.time() - started:6.1f}s  {verdict[:600]}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:])
