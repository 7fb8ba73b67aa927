"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tessera.oracles import ORACLES
from tessera.queries import QUERIES
from tessera.sources.tables import TABLES

from .conftest import SMALL


def _norm(v):
    if isinstance(v, float):
        return repr(v + 0.0)
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = duck.execute(ORACLES[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == exp


def test_entry_runs(spark):
    rows = entry(spark).collect()
    assert rows and all(r.n_tiles > 0 for r in rows)
    assert not math.isnan(sum(r.nbytes for r in rows))
