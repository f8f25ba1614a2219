"""Compare registered queries with their SQL: rows, columns and values regardless of order."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=repr
    )


def compare(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = table_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])} rows; {got[1][:2]} {want[1][:2]}"
    for g, w in zip(got[1], want[1]):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{g} != {w}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    from lodgeworks.catalog import ORACLES, QUERIES
    from lodgeworks.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:] or list(QUERIES)
    names = [n for n in QUERIES if any(n == c or n.startswith(c) for c in chosen)]
    spark = build_session(master="local[8]", spark__ui__enabled="false", spark__driver__memory="8g",
                          spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
                state = "ok" if problem is None else "DIFFERS " + problem[:400]
            else:
                state = f"rows {len(QUERIES[name](spark, sf_dir).collect())}"
        except Exception as error:  # noqa: BLE001
            state = "FAILED " + str(error)[:600]
        bad += state.startswith(("DIFFERS", "FAILED"))
        print(f"{name:40s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
