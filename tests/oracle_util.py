"""Run a registered query in Spark and its SQL oracle in DuckDB, and compare.

Comparison mirrors the driver's gate: column names (sorted), row count, and
an order-insensitive multiset of rows.  Doubles are compared exactly and,
separately, after rounding to 9 significant digits.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

from kohort.sources.tables import TABLE_NAMES, table_path


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')")
    return con


def _norm(v, digits: int | None):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if digits is None:
            return repr(v)
        return f"{v:.{digits}g}"
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


# Spark simple type name -> DuckDB type name of the same values
DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
             "date": "DATE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def types_match(spark_schema, duck_columns, duck_types) -> bool:
    """Column by column (matched by name), the Spark type equals DuckDB's."""
    duck = dict(zip(duck_columns, [str(t) for t in duck_types]))
    for f in spark_schema.fields:
        name = f.dataType.simpleString()
        if DUCK_TYPE.get(name, name.upper()) != duck.get(f.name):
            return False
    return True


def _rows(columns, rows, digits):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i], digits) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out = {
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": s_cols, "oracle_cols": d_cols,
        "spark_types": [f.dataType.simpleString() for f in df.schema.fields],
        "oracle_types": [str(t) for t in rel.types],
        "types_match": types_match(df.schema, d_cols, rel.types),
    }
    out["exact"] = out["columns_match"] and _rows(s_cols, s_rows, None) == _rows(d_cols, d_rows, None)
    out["rounded"] = out["columns_match"] and _rows(s_cols, s_rows, 9) == _rows(d_cols, d_rows, 9)
    if not out["rounded"] and out["columns_match"]:
        a = _rows(s_cols, s_rows, 9)
        b = _rows(d_cols, d_rows, 9)
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
    return out
