"""Every registered query against its SQL."""

from pathlib import Path

import pytest

import __spark_entry__ as registry
from oracle import compare, connect
from quillmark.sources.staging import job


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert registry._QUERIES.keys() == registry._ORACLE.keys()
    assert registry._QUERIES.keys() <= registry.queries().keys()
    assert registry.oracle_sql().keys() <= registry.queries().keys()


@pytest.mark.parametrize("name", registry._QUERIES)
def test_query_equals_sql(spark, sf_dir, connection, name):
    result = registry.queries()[name](spark, sf_dir)
    assert compare(result, connection, registry.oracle_sql()[name]) == []


def test_entry(spark):
    with job(spark) as folder:
        result = registry.entry(spark)
        assert result.columns == ["doc_id", "term", "tfidf"]
        assert not result.isEmpty()
        assert len(list(Path(folder).iterdir())) > 0
    assert not Path(folder).exists()
