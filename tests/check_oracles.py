"""Run registered queries against their SQL in DuckDB: ``python tests/check_oracles.py [sf] [key ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return repr(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, key, fn, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    df = fn(spark, sf_dir)
    got = df.collect()
    if sql is None:
        return None, len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    kinds = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "FLOAT": "float"}
    mine = dict(df.dtypes)
    for d in cur.description:
        k = kinds.get(str(d[1]), str(d[1]))
        if k != mine[d[0]] and "[" not in k:
            return f"type of {d[0]}: {mine[d[0]]} != {d[1]}", len(got)
    a, b = _rows(df.columns, got), _rows(names, want)
    if a == b:
        return None, len(got)
    sa, sb = set(a), set(b)
    return f"rows {len(a)}/{len(b)}; only spark {sorted(sa - sb)[:3]}; only sql {sorted(sb - sa)[:3]}", len(got)


def main() -> int:
    import __spark_entry__ as entry
    from vitalis.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:]
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    keys = [k for k in queries if not wanted or any(k == w or (w.endswith("*") and k.startswith(w[:-1])) for w in wanted)]
    bad = 0
    for key in keys:
        t = time.time()
        try:
            diff, n = compare(spark, con, key, queries[key], oracles.get(key), sf_dir)
        except Exception as e:  # report and go on
            diff, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        state = "FAIL" if diff else ("ok" if key in oracles else "rows")
        bad += bool(diff)
        print(f"{state:5s} {key:32s} rows={n:<7d} {time.time() - t:6.2f}s {diff or ''}", flush=True)
    print(f"{len(keys)} queries, {bad} failing, {sum(k in oracles for k in keys)} with SQL")
    return bad


if __name__ == "__main__":
    sys.exit(main())
