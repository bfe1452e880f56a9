"""Compare a Spark query result with its DuckDB oracle.

Same contract as the driver: equal row count, equal column names, and equal
multisets of rows after sorting the columns by name.  Floats are compared
after rounding to 6 decimals (both sides already round where it matters).
"""

from __future__ import annotations

import datetime as dt
import math

from turnstile.sources.tables import TABLES


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, bool):
        return v
    if isinstance(v, (int,)):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


_TYPE_NAMES = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
               "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "BooleanType": "BOOLEAN",
               "ShortType": "SMALLINT", "FloatType": "FLOAT", "ByteType": "TINYINT"}


def type_differences(spark_df, con, sql: str) -> list:
    """Columns whose Spark type does not correspond to the DuckDB type."""
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    out = []
    for f in spark_df.schema.fields:
        t = type(f.dataType).__name__
        got = duck.get(f.name)
        if got is None:
            continue
        ok = got.endswith("[]") if t == "ArrayType" else _TYPE_NAMES.get(t, t) == got
        if not ok:
            out.append((f.name, t, got))
    return out


def compare(spark_df, con, sql: str) -> dict:
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_names = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "names_match": sorted(s_names) == sorted(d_names)}
    if not res["names_match"]:
        res["spark_names"] = sorted(s_names)
        res["oracle_names"] = sorted(d_names)
        res["match"] = False
        return res
    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
    res["type_differences"] = type_differences(spark_df, con, sql)
    res["match"] = a == b
    if not res["match"]:
        diff_a = [x for x in a if x not in b][:3]
        diff_b = [x for x in b if x not in a][:3]
        res["spark_only"] = diff_a
        res["oracle_only"] = diff_b
    return res
