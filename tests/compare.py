"""Runs registered queries next to their SQL in DuckDB and reports differences.

python tests/compare.py SF_DIR [name-part ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(dtype: str) -> str:
    d = dtype.lower()
    if any(x in d for x in ("bigint", "int")):
        return "int"
    return "float" if d in ("double", "float") else d.replace("varchar", "string")


def _norm(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def check(spark_df, con, sql: str, times: dict | None = None) -> str:
    """Empty text if both sides agree, else what differs."""
    times = {} if times is None else times
    t0 = time.time()
    rel = con.sql(sql)
    want_types = {c: _kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    have_types = {c: _kind(t) for c, t in spark_df.dtypes}
    if want_types != have_types:
        return f"columns {sorted(have_types.items() - want_types.items())} against {sorted(want_types.items() - have_types.items())}"
    want = rows_of(rel.columns, rel.fetchall())
    times["duckdb"] = time.time() - t0
    t0 = time.time()
    have = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    times["collect"] = time.time() - t0
    if have == want:
        return ""
    extra = [r for r in have if r not in set(want)][:3]
    lack = [r for r in want if r not in set(have)][:3]
    return f"{len(have)} against {len(want)} rows; only here {extra}; only there {lack}"


def main() -> int:
    import __spark_entry__ as entry
    from zonetally.session import build_session

    sf_dir, parts = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, {"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    oracle = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        t0, times = time.time(), {}
        try:
            df = fn(spark, sf_dir)
            result = check(df, con, oracle[name], times) if name in oracle else f"(no SQL, {df.count()} rows)"
        except Exception as e:  # noqa: BLE001
            result = f"ERROR {str(e)[:600]}"
        bad += bool(result) and not result.startswith("(no SQL")
        print(f"{name:40s} {time.time() - t0:6.2f}s duckdb {times.get('duckdb', 0):5.2f} {result or 'ok'}", flush=True)
    print("differences:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
