"""The numbered queries as they are registered, on the smallest tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as contract  # noqa: E402
from compare import rows_of, types_of  # noqa: E402

from teletide.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no warehouse tables here")


def test_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())
    assert {*queries.ORACLES} <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = contract.queries()[name](spark, SF)
    relation = con.sql(queries.ORACLES[name])
    spark_types, duck_types = types_of(df, relation)
    assert spark_types == duck_types
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(relation.columns, relation.fetchall())
