"""Compare a Spark result with DuckDB SQL on the same tables.

Row count, column names, and an order-insensitive digest of the values over
name-sorted columns. Used by the tests and by ``tools/compare.py``.
"""

from __future__ import annotations

import hashlib
import math

from fieldnotes.sources.testdata import TABLES


def _norm(v) -> str:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)  # exact: no rounding of doubles
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows) -> tuple[str, list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(df, con, sql: str) -> dict:
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    h1, l1 = digest(cols, rows)
    h2, l2 = digest(ocols, orows)
    return {
        "rows": len(rows), "oracle_rows": len(orows),
        "cols_ok": sorted(cols) == sorted(ocols), "hash_ok": h1 == h2,
        "ok": sorted(cols) == sorted(ocols) and h1 == h2 and len(rows) == len(orows),
        "spark_only": sorted(set(l1) - set(l2))[:3], "oracle_only": sorted(set(l2) - set(l1))[:3],
    }
