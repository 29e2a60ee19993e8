"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{v:f}"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return str(v)


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def spark_side(df):
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    rows = sorted(tuple(_cell(r[n]) for n in names) for r in df.collect())
    return names, [_KINDS.get(kinds[n], kinds[n].upper()) for n in names], rows


def sql_side(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = [str(d[1]) for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted(tuple(_cell(r[i]) for i in order) for r in result.fetchall())
    return [names[i] for i in order], [kinds[i] for i in order], rows


def differences(df, con, sql) -> list[str]:
    """Empty when names, types, row count and values agree."""
    names, kinds, rows = spark_side(df)
    o_names, o_kinds, o_rows = sql_side(con, sql)
    out = []
    if names != o_names:
        out.append(f"columns {names} / {o_names}")
    elif [k.replace(" ", "") for k in kinds] != [k.replace(" ", "") for k in o_kinds]:
        out.append(f"types {list(zip(names, kinds, o_kinds))}")
    if len(rows) != len(o_rows):
        out.append(f"rows {len(rows)} / {len(o_rows)}")
    bad = [(a, b) for a, b in zip(rows, o_rows) if a != b]
    if bad:
        out.append(f"{len(bad)} values differ, first {bad[:2]}")
    return out
