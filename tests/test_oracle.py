"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from isoloom.plans.catalog import QUERIES
from isoloom.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_contract_is_complete(spark):
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert contract.entry(spark).columns[0] == "Sample"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert got == want
