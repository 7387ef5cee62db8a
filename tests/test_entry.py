"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from lacunar import queries as own

SF = "/root/testdata/sf0.001"
TABLES = ("region", "lineitem", "orders")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(rows):
    show = lambda v: f"{v + 0.0:.6f}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(v) for v in r) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(own.oracle_sql()))
def test_query(spark, duck, name):
    got = own.queries()[name](spark, SF)
    rel = duck.execute(own.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(got.columns)
    assert plain(got.select(*names).collect()) == plain(rel.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(own.queries()) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
