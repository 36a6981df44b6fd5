"""Queries that SQL can express, beside their SQL; and the contract of all."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from check import rows
from conftest import SF_SMALL
from countloom.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_all_are_registered():
    names = set(contract.queries())
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert set(queries.SQL) <= set(contract.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "encoding"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_twin(spark, name):
    result = queries.QUERIES[name](spark, SF_SMALL)
    got = rows(result.columns, [tuple(r) for r in result.collect()])
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    cursor = db.execute(queries.SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert got == rows(columns, cursor.fetchall())
    kinds = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double", "INTEGER": "int"}
    assert {c[0]: kinds[str(c[1])] for c in cursor.description} == dict(result.dtypes)
