"""Run a registered query and its SQL on the same files and compare the rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb

from filmloom.queries import ORACLES, QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    got = QUERIES[name](spark, sf_dir)
    if name not in ORACLES:
        got.count()
        return None
    relation = con.execute(ORACLES[name])
    columns = [d[0] for d in relation.description]
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    kinds = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "INTEGER": "int"}
    want_types = {d[0]: kinds.get(str(d[1]), str(d[1])) for d in relation.description}
    off = {c: (t, want_types[c]) for c, t in got.dtypes if t != want_types[c] and want_types[c] not in ("NUMBER", "STRING", "DATETIME", "bool")}
    want = _sorted(columns, relation.fetchall())
    have = _sorted(got.columns, [tuple(r) for r in got.collect()])
    if len(have) != len(want):
        return f"{len(have)} rows != {len(want)}"
    bad = [(h, w) for h, w in zip(have, want, strict=True) if h != w]
    if bad:
        return f"{len(bad)} of {len(have)} rows differ, e.g. {bad[0]}"
    return f"types {off}" if off else None
