"""Compare registered queries with their SQL counterparts; also a command line check."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        return repr(value + 0.0) if value % 1 else repr(float(value))
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else str(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder: str, fn, sql: str) -> str:
    """Empty when equal, else what differs."""
    df = fn(spark, folder)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return "" if got else "no rows"
    extra, lack = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"rows {len(got)} vs {len(want)}; only spark {extra[:3]}; only sql {lack[:3]}"


def main(folder: str, wanted: list[str]) -> None:
    from tidemark.session import build_session
    from tidemark.workload import all_oracles, all_queries

    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(folder), all_oracles(), 0
    chosen = {n: f for n, f in all_queries().items() if not wanted or any(w in n for w in wanted)}
    for name, fn in chosen.items():
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, con, folder, fn, oracles[name])
            else:
                verdict = f"rows only: {fn(spark, folder).count()}"
        except Exception as problem:
            verdict = f"{type(problem).__name__}: {str(problem)[:1500]}"
        bad += bool(verdict) and not verdict.startswith("rows only")
        print(f"{'ok ' if not verdict else '-- '} {name} {time.time() - start:.1f}s {verdict}", flush=True)
    print(f"{len(chosen)} queries, {bad} bad")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
