"""Every named query against its SQL."""

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from logweft.catalog.oracle import ORACLE
from logweft.catalog.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    smallest = check.connect("/root/testdata/sf0.001")
    names = [d[0] for d in smallest.execute(ORACLE["block_records"]).description]
    want = check.canonical(names, smallest.execute(ORACLE["block_records"]).fetchall())
    rows = entry(spark)
    assert check.canonical(rows.columns, [tuple(r) for r in rows.collect()]) == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert check.compare(spark, duck, name, SF) == ""
