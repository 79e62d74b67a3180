"""Every registered forecast query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from skyloom import plans

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return c


def rows(columns, found):
    def plain(v):
        if v is None or v != v:
            return None
        return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(repr([plain(r[c]) for c in sorted(columns)]) for r in found)


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES)


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, DATA)
    got = rows(df.columns, [r.asDict() for r in df.collect()])
    cursor = duck.execute(plans.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, [dict(zip(columns, r, strict=True)) for r in cursor.fetchall()])
