"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import datetime as dt
import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from dealspark.plans.keys import QUERIES

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_key_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 40 and "rank" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    drows = rel.fetchall()
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(rel.columns, drows)
