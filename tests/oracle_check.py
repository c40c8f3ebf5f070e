"""Run queries beside their SQL on DuckDB and compare. Usage: oracle_check.py SF_DIR [name part ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT", "float": "FLOAT",
}


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, sf: str, name: str, fn, sql: str | None) -> str:
    df = fn(spark, sf)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return f"rows only ({len(got)})" if got else "EMPTY"
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"COLUMNS {sorted(df.columns)} != {sorted(want_cols)}"
    off = {c: (t, want_types[c]) for c, t in df.dtypes if SPARK_TYPES.get(t, t) != want_types[c]}
    if len(got) != len(want):
        return f"ROWS {len(got)} != {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(want_cols, want)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"VALUES differ in {len(bad)} of {len(a)}: {sorted(df.columns)} {bad[:2]}"
    return f"TYPES {off}" if off else ("ok " if got else "ok but EMPTY ") + str(len(got))


def main() -> int:
    import __spark_entry__ as entry
    from ridepulse.session import local_session

    sf, parts = sys.argv[1], sys.argv[2:]
    spark, con = local_session("check", 8), duck(sf)
    queries, oracles, bad = entry.queries(), entry.oracle_sql(), 0
    for name, fn in queries.items():
        if parts and not any(p in name for p in parts):
            continue
        began = time.time()
        try:
            result = compare(spark, con, sf, name, fn, oracles.get(name))
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            result = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        fine = result.startswith(("ok ", "rows only")) and "EMPTY" not in result
        bad += not fine
        print(f"{'' if fine else '!! '}{name}: {result} [{time.time() - began:.1f}s]", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
