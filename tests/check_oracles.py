"""Compare registered queries with their SQL: python tests/check_oracles.py [folder] [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as registry  # noqa: E402


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    """Rows in a form that can be compared: columns by name, rows by content."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    """An empty text if both sides agree, else what differs."""
    df = registry.queries()[name](spark, folder)
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    relation = con.sql(registry.oracle_sql()[name])
    want = rows_of(relation.columns, relation.fetchall())
    if got == want:
        return ""
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    extra, missing = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    return (
        f"{len(got[1])} against {len(want[1])} rows, {len(extra)} and {len(missing)} differ: "
        f"{sorted(extra)[:2]} {sorted(missing)[:2]}"
    )


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the supplied tables as views."""
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    """Compare all (or the named) queries and print one line each."""
    from conftest import local_session

    spark = local_session()
    con = connect(folder)
    failures = 0
    for name in names or registry.queries():
        began = time.time()
        problem = compare(spark, con, folder, name)
        failures += bool(problem)
        print(f"{name:28} {time.time() - began:6.1f} s  {problem or 'same'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
