"""Compare registered queries with their SQL on one scale: python tools/verify.py [sf] [key prefix ...]"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.12g}")
    return v


def rows(names: list[str], data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in data)


def compare(con, spark, query, folder: str) -> str:
    df = query(spark, folder)
    got = rows(df.columns, (tuple(r) for r in df.collect()))
    if query.sql is None:
        return f"no SQL, {sum(got.values())} rows"
    cur = con.execute(query.sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return (f"FAIL rows spark={sum(got.values())} sql={sum(want.values())}\n    cols  {sorted(names)}\n"
                f"    spark {extra}\n    sql   {missing}")
    kinds = {(d[0], str(d[1])) for d in cur.description if any(k in str(d[1]) for k in ("HUGEINT", "DECIMAL", "DATE", "TIME ZONE"))}
    note = f" TYPES {sorted(kinds)}" if kinds else ""
    return f"ok {sum(got.values())} rows{note}" + (" EMPTY" if not got else "")


def main() -> int:
    from tidemark.catalog import load_all
    from tidemark.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark, con, bad = local_session(scratch=tempfile.mkdtemp(prefix="verify-")), connect(folder), 0
    for key, query in load_all().items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            result = compare(con, spark, query, folder)
        except Exception as e:  # noqa: BLE001
            result = f"FAIL {type(e).__name__}: {str(e)[:700]}"
        bad += result.startswith("FAIL")
        print(f"{key:40s} {time.time() - t0:6.2f}s {result}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
