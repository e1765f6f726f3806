"""Run registered queries against their SQL: python tests/compare.py [sf] [names]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TESTDATA = Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normalised(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    frame = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    got = normalised(frame.columns, [tuple(r) for r in frame.collect()])
    want = normalised(names, result.fetchall())
    if got == want:
        return None
    only_got = sorted(set(got) - set(want))[:3]
    only_want = sorted(set(want) - set(got))[:3]
    return f"{len(got)} rows != {len(want)} rows\n  spark  {only_got}\n  duckdb {only_want}"


def main() -> None:
    from tests.conftest import build_session
    import __spark_entry__ as e

    sf_dir = str(TESTDATA / (sys.argv[1] if len(sys.argv) > 1 else "sf0.01"))
    names = sys.argv[2:] or list(e.queries())
    spark, con = build_session(), connect(sf_dir)
    for name in names:
        start = time.perf_counter()
        try:
            if name in e.oracle_sql():
                found = difference(spark, con, sf_dir, e.queries()[name], e.oracle_sql()[name])
                state = "ok" if found is None else f"DIFFERS {found}"
            else:
                state = f"rows only: {len(e.queries()[name](spark, sf_dir).collect())}"
        except Exception as error:  # report and go on with the next query
            state = f"ERROR {type(error).__name__} {str(error)[:600]}"
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s {state}", flush=True)


if __name__ == "__main__":
    main()
