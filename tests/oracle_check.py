"""Local replica of the driver's correctness gate: run a plan in Spark and its
oracle SQL in DuckDB on the same parquet tables and compare columns, types,
row counts and the multiset of rounded values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(records, cols):
    out = [tuple(_norm(r[c]) for c in cols) for r in records]
    out.sort(key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    return out


def compare(spark_df, con, sql: str) -> dict:
    sp_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    sp_rows = [r.asDict(recursive=True) for r in spark_df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    dk_types = {d[0]: str(d[1]) for d in cur.description}
    dk_rows = [dict(zip(names, r)) for r in cur.fetchall()]
    res = {"spark_rows": len(sp_rows), "oracle_rows": len(dk_rows)}
    res["cols_ok"] = sorted(sp_types) == sorted(names)
    if not res["cols_ok"]:
        res["detail"] = f"spark cols {sorted(sp_types)} vs oracle {sorted(names)}"
        res["ok"] = False
        return res
    bad_types = {c: (sp_types[c], dk_types[c]) for c in names
                 if _SPARK_TO_DUCK.get(sp_types[c], sp_types[c]).upper() != dk_types[c].upper()}
    res["types_ok"] = not bad_types
    if bad_types:
        res["type_detail"] = bad_types
    cols = sorted(names)
    a, b = rows_of(sp_rows, cols), rows_of(dk_rows, cols)
    res["values_ok"] = a == b
    if not res["values_ok"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["detail"] = f"first diffs (spark, oracle) over {cols}: {diff}"
    res["ok"] = res["cols_ok"] and res["types_ok"] and res["values_ok"] and len(a) == len(b)
    return res
