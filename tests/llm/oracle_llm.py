"""Run a query of the corpus operators and its SQL over the same tables."""

import glob
import os

import duckdb

from filmloom.llm.queries import ORACLES


def connect(sf_dir: str, **tables) -> duckdb.DuckDBPyConnection:
    """Views over the tables of a folder; each may be a folder of part files. ``tables`` are data frames instead."""
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")
    return con


def compare(got, con, name: str) -> None:
    relation = con.execute(ORACLES[name])
    columns = [d[0] for d in relation.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted(map(repr, relation.fetchall()))
    have = sorted(repr(tuple(r)) for r in got.select(*columns).collect())
    assert have == want
