"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as contract
from compare import differences, sql_connection
from scoreflow.catalog.oracles import ORACLES
from scoreflow.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return sql_connection(sf_dir)


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    result = contract.queries()[name](spark, sf_dir)
    assert differences(result, con, contract.oracle_sql()[name]) == []


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["PNO", "prediction", "seconds", "minutes"]
    assert result.count() > 0
