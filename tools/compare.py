"""Run queries next to their oracles and report differences.

    python tools/compare.py [sf dir] [name prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compoundry.checks import catalog, fixtures  # noqa: E402
from compoundry.session import build_session  # noqa: E402


def canonical(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    t1 = time.time()
    if sql is None:
        return "rows", len(got), 0, t1 - t0, 0.0, ""
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    t2 = time.time()
    if sorted(cols) != sorted(df.columns):
        return "COLUMNS", len(got), len(want), t1 - t0, t2 - t1, f"{sorted(df.columns)} / {sorted(cols)}"
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a == b:
        return "ok", len(a), len(b), t1 - t0, t2 - t1, ""
    extra = [x for x in a if x not in set(b)][:2] if len(a) < 200000 else []
    lost = [x for x in b if x not in set(a)][:2] if len(b) < 200000 else []
    return "DIFF", len(a), len(b), t1 - t0, t2 - t1, f"spark {extra} / oracle {lost}"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in fixtures.BASE_TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    queries, oracles = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for name in sorted(queries):
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            status, n, m, s, d, note = compare(spark, con, name, queries[name], oracles.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            status, n, m, s, d, note = "ERROR", 0, 0, 0, 0, f"{type(e).__name__}: {str(e)[:600]}"
        bad += status not in ("ok", "rows")
        print(f"{status:8} {name:36} {n:8} {m:8} spark {s:6.2f}s oracle {d:6.2f}s {note}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
