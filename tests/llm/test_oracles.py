"""Every query of the subpackage that SQL can express, against its SQL; the others run to the end."""

import pytest
from oracle import compare, connect

import __spark_entry__ as registry
from quillmark.llm import queries


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), connection, queries.ORACLE_SQL[name]) == []


def test_all_thirteen_and_the_pipeline_are_registered():
    names = [name for name in registry.queries() if name.startswith("op") and "_" in name]
    assert {int(name[2:].split("_")[0]) for name in names} >= set(range(1, 14))
    assert "pipeline" in registry.queries()
