"""Run a registered query and its SQL on the same tables and compare the results exactly."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value) -> str:
    if isinstance(value, float) and value == 0:
        value = 0.0  # -0.0
    return repr(value)


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, plan, sql: str, sf_dir: str) -> str | None:
    got_df = plan(spark, sf_dir)
    got = canonical(got_df.columns, [tuple(r) for r in got_df.collect()])
    result = con.execute(sql)
    want = canonical([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, SQL gives {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(bad)} rows differ, first: {bad[0]}" if bad else None


if __name__ == "__main__":
    from brindle.plans import registered
    from brindle.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    session = local_session("compare", 8)
    catalog, con = registered(), duck(sf_dir)
    wanted = sys.argv[1:]
    for name, plan in catalog.plans.items():
        if wanted and not any(w in name for w in wanted):
            continue
        started = time.time()
        try:
            if name in catalog.oracles:
                outcome = difference(session, con, plan, catalog.oracles[name], sf_dir) or "ok"
            else:
                outcome = f"rows only: {plan(session, sf_dir).count()}"
        except Exception as problem:  # report and go on with the next query
            outcome = f"{type(problem).__name__}: {str(problem)[:1500]}"
        print(f"{name:32s} {time.time() - started:6.2f}s  {outcome[:1800]}", flush=True)
