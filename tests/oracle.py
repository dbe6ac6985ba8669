"""Runs a registered query and its SQL twin and compares the results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, bool):
        return v
    return v


def rows_of(names, rows):
    at = [names.index(n) for n in sorted(names)]
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return type(a) is type(b) and a == b


def compare(spark, con, folder: str, name: str, query) -> dict:
    start = time.time()
    df = query.run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    out = {"name": name, "rows": len(got), "seconds": round(seconds, 2), "problem": ""}
    if query.sql is None:
        return out
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        out["problem"] = f"columns {sorted(df.columns)} != {sorted(names)}"
        return out
    if len(got) != len(want):
        out["problem"] = f"{len(got)} rows != {len(want)}"
        return out
    left, right = rows_of(df.columns, got), rows_of(names, want)
    wrong = [(a, b) for a, b in zip(left, right) if not all(map(same, a, b))]
    exact = sum(a != b for a, b in zip(left, right))
    if wrong:
        out["problem"] = f"{len(wrong)} rows differ, first {wrong[0]} {sorted(names)}"
    elif exact:
        out["problem"] = f"{exact} rows differ in the last digits"
    return out


def main() -> None:
    from linesmith.plans.catalog import all_queries
    from linesmith.session import local_session
    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    con = connect(folder)
    bad = 0
    for name, q in all_queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            out = compare(spark, con, folder, name, q)
        except Exception as error:  # report and go on with the next query
            out = {"name": name, "rows": -1, "seconds": 0, "problem": f"{type(error).__name__}: {str(error)[:1500]}"}
        bad += bool(out["problem"])
        print(f"{out['name']:24} rows={out['rows']:7} {out['seconds']:6}s "
              f"{'sql' if q.sql else '---'} {out['problem'][:1800] or 'ok'}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main()
