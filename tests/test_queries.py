"""Every registered query against its DuckDB oracle at sf0.001 (the
driver's check at a smaller scale); queries without SQL must run."""

import math

import duckdb
import pytest

from canopy.plans.registry import load_all
from canopy.sources.tables import TABLES
from tests.conftest import SF_SMALL

REG = load_all()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(REG))
def test_query(spark, con, name):
    q = REG[name]
    df = q.build(spark, SF_SMALL)
    cols = sorted(df.columns)
    rows = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if q.sql is None:
        assert rows is not None
        return
    res = con.execute(q.sql)
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    drows = sorted((tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in res.fetchall()), key=repr)
    assert rows == drows
