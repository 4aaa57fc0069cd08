"""Every query against its SQL, on the small tables."""

import math
from collections import Counter
from datetime import datetime

import duckdb
import pytest
from lattica.plans.queries import ORACLES, QUERIES
from lattica.sources.readers import TABLES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v) if isinstance(v, datetime) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    a = Counter(tuple(plain(r[c]) for c in sorted(names)) for r in got.collect())
    b = Counter(tuple(plain(dict(zip(names, r))[c]) for c in sorted(names)) for r in want.fetchall())
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_other_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
