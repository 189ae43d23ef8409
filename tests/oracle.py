"""Spark-vs-DuckDB comparison used by the tests and by ``check_oracle.py``.

Columns are compared by name, rows as an order-insensitive multiset of
normalised values (numbers to 6 decimals, timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from cardwatch.fixtures import BASE_TABLES


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float) and math.isnan(v):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    return str(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())


# Spark type -> DuckDB type name, for the schema part of the comparison
TYPES = {"StringType()": "VARCHAR", "IntegerType()": "INTEGER", "LongType()": "BIGINT",
         "TimestampNTZType()": "TIMESTAMP", "BooleanType()": "BOOLEAN",
         "DecimalType(10,2)": "DECIMAL(10,2)", "DoubleType()": "DOUBLE"}


def compare(spark, name, sf_dir, queries, oracle, con=None):
    """Returns (ok, message): same column names and types, same multiset of rows."""
    con = con or duck_connection(sf_dir)
    sdf = queries[name](spark, sf_dir)
    stypes = {f.name: TYPES.get(str(f.dataType), str(f.dataType)) for f in sdf.schema.fields}
    scols, srows = rows_of_spark(sdf)
    if name not in oracle:
        return True, f"{name}: {len(srows)} rows (no oracle)"
    rel = con.sql(oracle[name])
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    dcols, drows = rows_of_duck(con, oracle[name])
    if scols != dcols:
        return False, f"{name}: columns differ spark={scols} duck={dcols}"
    if stypes != dtypes:
        return False, f"{name}: types differ spark={stypes} duck={dtypes}"
    if srows != drows:
        s, d = set(srows), set(drows)
        return False, (f"{name}: rows differ spark={len(srows)} duck={len(drows)}; "
                       f"only spark {sorted(s - d)[:3]} only duck {sorted(d - s)[:3]}")
    return True, f"{name}: {len(srows)} rows match"
