"""Every query of the catalogue against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from scholarloom.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(SF):
        c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return c


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    r = duck.execute(ORACLE[name])
    cols = [c[0] for c in r.description]
    assert sorted(cols) == sorted(df.columns)
    key = lambda rows: sorted(repr([plain(x) for x in row]) for row in rows)
    assert key(df.select(*cols).collect()) == key(r.fetchall())
