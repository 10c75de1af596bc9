"""Queries that have a SQL twin, on the smallest tables."""

import os

import duckdb
import pytest

from boxloom.llm import registry
from tests.test_queries import rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    want = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())


def test_every_operator_has_a_query():
    names = set(registry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert set(registry.oracle_sql()) <= names
