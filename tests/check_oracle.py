"""Runs every registered query and its SQL oracle and compares them.

    python tests/check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(row[i] for i in order) for row in cursor.fetchall())


def spark_rows(frame) -> tuple[list[str], Counter]:
    names = sorted(frame.columns)
    return names, Counter(tuple(row) for row in frame.select(*names).collect())


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.time()
    names, rows = spark_rows(entry.queries()[name](spark, sf_dir))
    seconds = time.time() - started
    want_names, want = oracle_rows(con, entry.oracle_sql()[name])
    same = names == want_names and rows == want
    note = f"{sum(rows.values())} rows, oracle {sum(want.values())}, {seconds:.2f} s"
    if not same:
        note += f"; only here {list((rows - want))[:2]}, only oracle {list((want - rows))[:2]}"
    return same, note


def main() -> int:
    from deposit_analytics.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = build_session("check", "local[8]", 8, **quiet)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or entry.oracle_sql():
        same, note = compare(spark, con, sf_dir, name)
        bad += not same
        print("ok  " if same else "BAD ", name, note, flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
