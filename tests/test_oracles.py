"""Every registered query against its SQL."""

import duckdb
import pytest

from __spark_entry__ import entry
from check import normal
from workload.oracles import ORACLES
from workload.queries import QUERIES
from workload.raw_tables import TABLES


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    got = normal(result.columns, [tuple(r) for r in result.collect()])
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert got and got == normal(columns, cursor.fetchall())
