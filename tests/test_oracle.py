"""Every registered query against its DuckDB oracle on the smallest scale."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from ovenbird.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(str(x) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) & set(REGISTRY)))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(scols) == sorted(dcols)
    assert _rows(scols, srows) == _rows(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
