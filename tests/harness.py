"""Side-by-side check of a Spark query against its DuckDB oracle (row count, columns, values)."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

from cobble.session import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return float(f"{float(v):.9g}")
    except Exception:
        pass
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if "sep" in v.isoformat.__doc__ else v.isoformat()
    return v


# Spark type -> DuckDB type name of the same kind.
_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = list(spark_df.columns)
    s_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema.fields}
    s_rows = spark_df.collect()
    rel = con.sql(sql)
    d_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    d = con.execute(sql)
    d_cols = [c[0] for c in d.description]
    d_rows = d.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    bad_types = {c: (s_types[c], d_types.get(c)) for c in s_cols if s_types[c] != d_types.get(c)}
    if bad_types:
        return False, f"types differ (spark, duck): {bad_types}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}; e.g. spark-only={list((sc - dc).items())[:3]} duck-only={list((dc - sc).items())[:3]}"
    if sc != dc:
        return False, f"values differ: spark-only={list((sc - dc).items())[:3]} duck-only={list((dc - sc).items())[:3]}"
    return True, f"{len(s_rows)} rows"
