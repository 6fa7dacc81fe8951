"""Compare a registered query with its SQL twin (DuckDB) — a test helper."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
from collections import Counter

from ledgerlane.sources.tables import TABLES


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, int):
        return float(v) if abs(v) < 2**53 else v
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return str(v)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    rows = df.select(*cols).collect()
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    ocols = list(rel.columns)
    orows = rel.fetchall()
    res = {"name": name, "rows": len(rows), "oracle_rows": len(orows)}
    if sorted(ocols) != cols:
        res["ok"] = False
        res["why"] = f"columns {cols} vs {sorted(ocols)}"
        return res
    idx = [ocols.index(c) for c in cols]
    a = Counter(tuple(_norm(r[i]) for i in range(len(cols))) for r in rows)
    b = Counter(tuple(_norm(r[i]) for i in idx) for r in orows)
    res["ok"] = a == b
    if a != b:
        res["only_spark"] = list((a - b).elements())[:3]
        res["only_sql"] = list((b - a).elements())[:3]
    return res
