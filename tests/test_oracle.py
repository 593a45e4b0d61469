"""Every named query against DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
import check


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.duck(sf_dir)


@pytest.mark.parametrize("name", list(entry_module.queries()))
def test_query(spark, con, sf_dir, name):
    df = entry_module.queries()[name](spark, sf_dir)
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert check.compare(df, con, sql) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["source", "age", "gender", "file_name"] and df.count() > 0


def test_oracles_belong_to_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
