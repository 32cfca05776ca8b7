"""Compare registered queries with their SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(spark, con, run, statement: str, sf_dir: str) -> list[str]:
    """Empty when names, rows and values agree exactly."""
    df = run(spark, sf_dir)
    result = con.execute(statement)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns differ: {sorted(set(names) ^ set(df.columns))}"]
    ours = canonical([tuple(r) for r in df.collect()], df.columns)
    theirs = canonical(result.fetchall(), names)
    found = []
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} here, {len(theirs)} in SQL")
    for mine, other in zip(ours, theirs):
        if repr(mine) != repr(other):
            named = sorted(names)
            found.append(
                "; ".join(f"{n}: {a!r} / {b!r}" for n, a, b in zip(named, mine, other) if a != b or type(a) is not type(b))
            )
        if len(found) >= 3:
            break
    if not ours:
        found.append("no rows: the comparison shows nothing")
    return found


def main() -> None:
    from pampero.session import build_session
    from verification.catalog import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            found = differences(spark, con, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as error:  # report and go on with the others
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     ", line[:1500], flush=True)
        if found:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
