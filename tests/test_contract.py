import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, kinds, rows
from conftest import SF_SMALL, scalar
from countloom import oracle, workloads


def test_every_query_has_a_twin():
    assert set(workloads.QUERIES) == set(oracle.sql())
    assert set(workloads.QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert scalar(contract.entry(spark)) == 7_852


@pytest.mark.parametrize("name", sorted(workloads.QUERIES))
def test_query_equals_its_twin(spark, name):
    result = contract.queries()[name](spark, SF_SMALL)
    got = rows(result.columns, [tuple(r) for r in result.collect()])
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    cursor = db.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert kinds(cursor.description) == dict(result.dtypes)
    assert got == rows(columns, cursor.fetchall())
