"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from teletide.plans.catalog import QUERIES as CATALOG  # noqa: E402
from compare import TABLES, rows_of, types_of  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = {name: fn for name, fn in contract.queries().items() if name in CATALOG}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in CATALOG}
# Sketches, whose results only need to exist.
WITHOUT_SQL = {"span_red_approx", "sql_approx_distinct"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no warehouse tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    assert got or name == "docs_match"
    if name in ORACLES:
        relation = duck.sql(ORACLES[name])
        spark_types, duck_types = types_of(df, relation)
        assert spark_types == duck_types
        assert rows_of(df.columns, got) == rows_of(relation.columns, relation.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["bucket_time", "labels", "count"] and df.count() > 0
