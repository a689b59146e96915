"""Run registered queries against their SQL twins on one data folder."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 4) + 0.0
    return value


def duck(folder: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def compare(spark, folder: str, query, sql: str, con=None) -> dict:
    """Row counts, column names and sorted values of both sides."""
    con = con or duck(folder)
    started = time.time()
    df = query(spark, folder)
    names = sorted(df.columns)
    left = [tuple(_cell(r[c]) for c in names) for r in df.select(*[f"`{c}`" for c in names]).collect()]
    spark_seconds = time.time() - started
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    order = [columns.index(c) for c in names] if sorted(columns) == names else None
    if order is None:
        return {"ok": False, "why": f"columns differ: {sorted(set(columns) ^ set(names))[:10]}", "sec": spark_seconds}
    right = [tuple(_cell(r[i]) for i in order) for r in relation.fetchall()]
    if len(left) != len(right):
        return {"ok": False, "why": f"rows {len(left)} vs {len(right)}", "sec": spark_seconds}
    key = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    left.sort(key=key)
    right.sort(key=key)
    for a, b in zip(left, right):
        if a != b:
            bad = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
            return {"ok": False, "why": f"values differ: {bad[:4]}", "sec": spark_seconds}
    return {"ok": True, "rows": len(left), "sec": spark_seconds}


def main(argv: list[str]) -> int:
    from leadforge.catalog import registry
    from leadforge.session import local_session

    folder = os.environ.get("CHECK_DIR", "/root/testdata/sf0.01")
    spark = local_session(8)
    con = duck(folder)
    queries, oracles = registry.queries(), registry.oracles()
    keys = [k for k in queries if not argv or any(a in k for a in argv)]
    failed = 0
    for key in keys:
        try:
            if key in oracles:
                result = compare(spark, folder, queries[key], oracles[key], con)
            else:
                started = time.time()
                result = {"ok": True, "rows": queries[key](spark, folder).count(), "sec": time.time() - started, "why": "no SQL twin"}
        except Exception as error:  # noqa: BLE001
            result = {"ok": False, "why": f"{type(error).__name__}: {str(error)[:600]}", "sec": 0}
        failed += not result["ok"]
        print(f"{'ok  ' if result['ok'] else 'FAIL'} {key:32s} {result.get('rows', '-')!s:>8} rows {result['sec']:6.1f}s {result.get('why', '')}", flush=True)
    print(f"{len(keys) - failed} of {len(keys)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
