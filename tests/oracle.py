"""Compare a registered query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from tidemark.session import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(" ")
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def kinds(con_result, df):
    """Column types of both sides in coarse classes."""
    def duck(ty):
        ty = str(ty).upper()
        if ty.startswith(("DECIMAL", "HUGEINT")):
            return "decimal"
        if ty in ("DOUBLE", "FLOAT"):
            return "float"
        if "INT" in ty:
            return "int"
        return ty.split("(")[0].split("[")[0].lower()

    names = {"long": "int", "integer": "int", "double": "float", "string": "varchar",
             "timestamp_ntz": "timestamp", "boolean": "boolean"}
    d = {c[0]: duck(c[1]) for c in con_result.description}
    s = {f.name: names.get(f.dataType.typeName(), f.dataType.typeName()) for f in df.schema.fields}
    return {c: (s.get(c), d.get(c)) for c in sorted({*d, *s}) if s.get(c) != d.get(c)}


def compare(spark, con, sf_dir, fn, sql):
    """None when equal, else a short account of the difference."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    types = kinds(res, df)
    want = rows_of([c[0] for c in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    if got[1] != want[1]:
        bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
        return f"{len(bad)} rows differ, first: {bad[0]}"
    if types:
        return f"types (spark, duckdb): {types}"
    return None
