"""Compare every registered query with its SQL: ``python -m verification.check [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from tableferry.session import build_session
from verification.queries import ORACLES, QUERIES


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    answer = con.execute(ORACLES[name])
    expected_columns = [d[0] for d in answer.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} and {sorted(expected_columns)}"
    types = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    have = {c: types.get(t, t) for c, t in df.dtypes}
    want = {d[0]: str(d[1]) for d in answer.description}
    if have != want:
        return f"types {[(c, have[c], want[c]) for c in have if have[c] != want[c]]}"
    got = rows_of(df.columns, df.collect())
    expected = rows_of(expected_columns, answer.fetchall())
    if got != expected:
        first = next((p for p in zip(got, expected) if p[0] != p[1]), None)
        return f"{len(got)} and {len(expected)} rows, first difference {first}"
    return None if got else "no rows"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as e:  # report the query and go on with the next
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
