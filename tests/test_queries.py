"""Each query of the catalog against its SQL twin, on the smallest tables."""

import math
import os

import duckdb
import pytest

from boxloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("lineitem", "orders", "events", "documents", "embeddings", "pages", "labels", "conversations")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    return round(float(v), 6) if isinstance(v, (int, float)) else str(v)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    want = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())
