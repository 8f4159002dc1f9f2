"""Runs registered queries and their SQL twins side by side and compares whole results.

    python tests/oracle.py [sf] [name prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, (int, decimal.Decimal)):
        return float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else x + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(plain(i) for i in x)
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql) -> str:
    """Empty text if equal, else what differs."""
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; e.g. {got[:1]} / {want[:1]}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, e.g. {str(bad[0])[:600]}" if bad else ""


def main() -> None:
    import __spark_entry__ as entry
    from tidemill import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(f"/root/testdata/sf{sf}"), entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name == w or name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            df = fn(spark, f"/root/testdata/sf{sf}")
            if name in sqls:
                diff = compare(df, con, sqls[name])
                state = "DIFF " + diff if diff else "ok"
            else:
                state = f"rows {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            state = "FAIL " + str(e)[:700].replace("\n", " ")
        bad += state.startswith(("DIFF", "FAIL"))
        print(f"{time.time() - t:6.1f}s {name}: {state}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
